"""A search over few rows: its jobs are few and have few tasks, whatever the partitions its rows come in."""

import numpy as np
import pytest

from creditloom.catalog import trees
from creditloom.operators import boosting as B
from creditloom.operators import histograms as H
from creditloom.operators import models as L
from creditloom.operators.search import Study
from creditloom.operators.selection import model_search, packed


class Probe:
    """A logistic model that notes the partitions and the rows it is fitted to."""

    def __init__(self, features, seen):
        self.features, self.seen = features, seen

    def fit(self, train):
        self.seen.append((train.rdd.getNumPartitions(), train.count()))
        return L.logistic(self.features, max_iter=3).fit(train)


def test_search_fits_few_rows_in_one_task(spark):
    rows = [(i, int(i * 7 % 10 < 4 + i % 3), i % 3, float(i % 11), float(i * i % 17)) for i in range(300)]
    df = spark.createDataFrame(rows, "SK_ID_CURR bigint, TARGET int, fold int, a double, b double").repartition(24)
    seen = []
    found = model_search(df, ["a", "b"], "TARGET", "fold", 3, lambda f, p, share: Probe(f, seen), Study({"threshold": ("float", 0.3, 0.6)}), 2).collect()
    assert seen == [(1, 200)] * 6
    assert [r["state"] for r in found] == ["complete"] * 2 and all(0 < r["auc"] < 1 for r in found)


def test_packing_keeps_rows_and_follows_their_number(spark):
    df = spark.range(1000).repartition(24).persist()
    assert [packed(df, n).rdd.getNumPartitions() for n in (1000, 999, 100, 10)] == [1, 2, 10, 24]
    assert packed(df, 100).selectExpr("count(*) AS n", "sum(id) AS s").first() == (1000, 499500)
    df.unpersist()


NAMES = [f"f{j}" for j in range(4)]


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 4)).round(2)
    y = (x[:, 0] * x[:, 1] + np.sin(3 * x[:, 2]) + x[:, 3] + rng.normal(size=4000) > 0).astype(int)
    rows = [(i, int(y[i]), *[None if rng.random() < 0.1 else float(v) for v in x[i]]) for i in range(4000)]
    return spark.createDataFrame(rows, "SK_ID_CURR bigint, TARGET int, " + ", ".join(f"{f} double" for f in NAMES)).repartition(16).cache()


def test_a_tree_takes_no_more_histograms_than_levels(noisy, monkeypatch):
    seen = []
    original = B.NullRoutingTrees._histograms

    def spied(self, graded, wanted, *args):
        seen.append((graded.tasks, len(wanted)))
        return original(self, graded, wanted, *args)

    monkeypatch.setattr(B.NullRoutingTrees, "_histograms", spied)
    m = B.NullRoutingTrees(NAMES, trees=2, max_depth=6, max_leaves=31, min_rows=5).fit(noisy)
    assert [sum(n.feature is None for n in t.values()) for t in m.trees] == [31, 31]
    assert len(seen) <= 2 * 6 and {tasks for tasks, _ in seen} == {1} and max(n for _, n in seen) <= 32


def test_trees_do_not_depend_on_how_rows_are_dealt(noisy, monkeypatch):
    twelve = B.NullRoutingTrees(NAMES, trees=12, max_depth=4, subsample=0.7, feature_share=0.75, positive_weight=3.0)
    whole = twelve.fit(noisy)
    monkeypatch.setattr(B, "ROWS_PER_TASK", 500)
    monkeypatch.setattr(B, "DIRECT_BYTES", 0)
    dealt = twelve.fit(noisy)
    assert len(whole.nodes) == len(dealt.nodes) > 12 * 8
    for a, b in zip(whole.nodes, dealt.nodes):
        assert (a.tree, a.node, a.feature, a.cut, a.null_left, a.left, a.right, a.n_rows) == (b.tree, b.node, b.feature, b.cut, b.null_left, b.left, b.right, b.n_rows)
        assert [a.value or 0, a.gain or 0] == pytest.approx([b.value or 0, b.gain or 0], rel=1e-6)


def test_draws_are_those_of_sql(spark):
    rows = spark.range(50).selectExpr("id * 7919 AS k").selectExpr("xxhash64(k, 42) AS seed", "xxhash64(k, 42, 5) AS at_5", "xxhash64(k, 42, -3) AS at_minus_3").toPandas()
    for value, name in ((5, "at_5"), (-3, "at_minus_3")):
        assert H.hashed_int(value, rows["seed"].to_numpy()).tolist() == rows[name].tolist()


def test_gains_at_the_root_with_few_or_no_targets(spark, monkeypatch):
    def gains(targets):
        rows = [(i, t, float(i % 25), float(i % 9) * 100_000 + 500_000, float(i % 17), -1000.0 - i) for i, t in enumerate(targets)]
        frame = spark.createDataFrame(rows, "SK_ID_CURR bigint, TARGET int, NATION double, DEBT double, N_CREDITS double, DAYS double")
        monkeypatch.setattr(trees, "holed", lambda *_: frame)
        return {(r["feature"], r["cut"], r["null_left"]): (r["n_left"], r["n_right"], r["gain"]) for r in trees.null_gain_table(spark, "").collect()}

    found = gains([None if i % 5 == 0 else int(i % 25 < 10) for i in range(200)])
    n_left, n_right, gain = found["NATION", 9.0, True]
    p, left, right = 0.4, (64 * 0.4 - 64, 80 * 0.24), (96 * 0.4, 120 * 0.24)  # a row without a target counts, with no gradient
    assert (n_left, n_right) == (80, 120) and gain == pytest.approx(left[0] ** 2 / (left[1] + 1) + right[0] ** 2 / (right[1] + 1) - 0 / (200 * p * (1 - p) + 1), abs=1e-5)
    assert set(gains([1] * 100).values()) and {g for *_, g in gains([1] * 100).values()} == {0.0}
    assert gains([None] * 100) == {} and gains([]) == {}
