"""Trees that route NULL, their exact contributions, and the search over them."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import boosting as B
from creditloom.operators import tree_shapley as T
from creditloom.operators.explain import exact_shapley
from creditloom.operators.search import Parzen, Study, run


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(7)
    out = []
    for i in range(3000):
        x = [None if rng.random() < 0.2 else float(round(rng.normal(), 2)) for _ in range(6)]
        z = (x[0] or -1.5) + (1.0 if x[1] is None else 0.0) + (x[2] or 0) * (x[3] or 0) - 0.5
        out.append((i, int(rng.random() < 1 / (1 + math.exp(-z))), *x))
    return spark.createDataFrame(out, "SK_ID_CURR bigint, TARGET int, " + ", ".join(f"f{j} double" for j in range(6))).cache()


NAMES = [f"f{j}" for j in range(6)]


@pytest.fixture(scope="module")
def model(rows):
    return B.NullRoutingTrees(NAMES, trees=5, max_leaves=12, max_depth=5, rate=0.3, bins=16).fit(rows)


def brute_tree(x, y, cuts, leaves, min_rows, l2):
    """Leaf-wise growth on all rows, one tree: (gain sequence, score per row)."""
    p = y.mean()
    g, h = p - y, np.full(len(y), p * (1 - p))
    groups, gains = [np.ones(len(y), bool)], []

    def best(m):
        top = None
        for j in range(x.shape[1]):
            for c in [*cuts[j], math.inf]:
                for null_left in (True, False):
                    left = np.where(np.isnan(x[:, j]), null_left, x[:, j] <= c) & m
                    right = m & ~left
                    if min(left.sum(), right.sum()) < min_rows:
                        continue
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + l2) * k for s, k in ((left, 1), (right, 1), (m, -1)))
                    if gain > 1e-12 and (top is None or gain > top[0] * (1 + 1e-9)):
                        top = (gain, left, right)
        return top

    while len(groups) < leaves:
        options = [(best(m), i) for i, m in enumerate(groups)]
        options = [(t, i) for t, i in options if t]
        if not options:
            break
        (gain, left, right), i = max(options, key=lambda o: o[0][0])
        gains.append(gain)
        groups[i:i + 1] = [left, right]
    score = np.zeros(len(y))
    for m in groups:
        score[m] = -g[m].sum() / (h[m].sum() + l2)
    return gains, score + math.log(p / (1 - p))


def test_one_tree_equals_brute_force(spark, rows):
    table = rows.orderBy("SK_ID_CURR").toPandas()
    x, y = table[NAMES].to_numpy(float), table["TARGET"].to_numpy(float)
    cuts = {f: [-1.0, -0.3, 0.0, 0.4, 1.1] for f in NAMES}
    model = B.NullRoutingTrees(NAMES, trees=1, rate=1.0, max_leaves=7, min_rows=40, min_hessian=0.0, cuts=cuts, leaves_per_job=3).fit(rows)
    gains, score = brute_tree(x, y, [cuts[f] for f in NAMES], 7, 40, 1.0)
    assert sorted(n.gain for n in model.nodes if n.feature) == pytest.approx(sorted(gains), rel=1e-9)
    got = [r[0] for r in rows.orderBy("SK_ID_CURR").select(model.margin()).collect()]
    assert got == pytest.approx(score.tolist(), abs=1e-9)


def test_null_takes_its_own_way_and_loss_falls(rows, model):
    assert any(n.feature and not n.null_left for n in model.nodes) and any(n.feature and n.null_left for n in model.nodes)

    def loss(m):
        z = F.when(F.col("TARGET") == 1, m).otherwise(-m)
        return rows.agg(F.avg(F.log(1 + F.exp(-z)))).first()[0]

    parts = [loss(B.TreeModel(NAMES, model.base, [n for n in model.nodes if n.tree < t]).margin()) for t in range(6)]
    assert all(a > b for a, b in zip(parts, parts[1:]))
    scored = model.transform(rows.where("f0 is null")).select("probability").first()[0]
    assert abs(sum(scored) - 1) < 1e-12 and abs(sum(model.featureImportances) - 1) < 1e-9


def test_saved_model_is_the_same_and_counts_are_a_walk(spark, rows, model, tmp_path):
    model.write_to(spark, str(tmp_path / "m"))
    again = B.TreeModel.read_from(spark, str(tmp_path / "m"), NAMES)
    assert again.base == model.base and again.nodes == model.nodes
    counts = {r.feature: (r.n_splits, r.total_gain) for r in B.split_counts(spark.read.parquet(str(tmp_path / "m"))).collect()}
    walked = {}
    for tree in again.trees:
        todo = [0]
        while todo:
            n = tree[todo.pop()]
            if n.feature is not None:
                walked.setdefault(n.feature, []).append(n.gain)
                todo += [n.left, n.right]
    assert {f: (len(g), pytest.approx(sum(g))) for f, g in walked.items()} == counts


def test_only_histograms_reach_the_driver(rows, monkeypatch):
    seen = []
    original = B.NullRoutingTrees._histograms

    def spied(self, graded, wanted, n_features, width):
        out = original(self, graded, wanted, n_features, width)
        seen.append((len(wanted), sum(int((h[2] > 0).sum()) for h in out.values())))
        return out

    monkeypatch.setattr(B.NullRoutingTrees, "_histograms", spied)
    B.NullRoutingTrees(NAMES, trees=1, max_leaves=16, bins=8, leaves_per_job=4).fit(rows)
    assert all(cells <= leaves * 6 * 9 for leaves, cells in seen) and len(seen) < 15


def test_awkward_rows(spark):
    frame = spark.createDataFrame([(i, i % 2, float("nan") if i % 4 < 2 else None, None) for i in range(200)] + [(999, None, 1.0, 1.0)], "SK_ID_CURR bigint, TARGET int, `a b` double, c double")
    m = B.NullRoutingTrees(["a b", "c"], trees=2).fit(frame)
    assert not [n for n in m.nodes if n.feature]  # nothing to split on
    one = B.NullRoutingTrees(["c"]).fit(frame.where("TARGET = 1"))
    assert one.nodes == [] and one.base > 5 and B.NullRoutingTrees(["c"]).fit(frame.limit(0)).nodes == []
    split = B.NullRoutingTrees(["a b"], trees=1, max_leaves=2).fit(frame.withColumn("a b", F.when(F.col("TARGET") == 1, F.lit(1.0))))
    assert [(n.cut, n.null_left) for n in split.nodes if n.feature] == [(1.0, False)]  # the first of equal cuts: known values left, NULL right
    got = split.transform(frame.withColumn("a b", F.when(F.col("TARGET") == 1, F.lit(1.0)))).groupBy("TARGET").agg(F.avg("margin").alias("m")).collect()
    assert {r.TARGET: r.m > 0 for r in got if r.TARGET is not None} == {0: False, 1: True}


def test_contributions_equal_enumeration(spark, rows, model):
    background = [{f: r[f] for f in NAMES} for r in rows.where("SK_ID_CURR % 300 = 5").select(*NAMES).collect()]
    some = rows.where("SK_ID_CURR < 60")

    def value(s):
        total = F.lit(0.0)
        for b in background:
            sql = " + ".join(B.tree_sql(t) for t in model.trees)
            for f in NAMES:
                if f not in s:
                    sql = sql.replace(f"`{f}`", "double(NULL)" if b[f] is None else f"double('{b[f]!r}')")
            total = total + F.expr(sql) + model.base
        return total / len(background)

    assert "`f0`" in B.tree_sql(model.trees[0]) or "f0" in B.tree_sql(model.trees[0])
    want = {r.SK_ID_CURR: r for r in exact_shapley(some, NAMES, value).collect()}
    got = T.tree_contributions(some, model, background).collect()
    assert len(got) == 60
    for r in got:
        w = want[r.SK_ID_CURR]
        assert [r.base_value, r.output, *[r[f] for f in NAMES]] == pytest.approx([w.base_value, w.output, *[w[f] for f in NAMES]], abs=1e-9)
        assert r.base_value + sum(r[f] for f in NAMES) == pytest.approx(r.output, abs=1e-9)
    for r in T.tree_contributions(some, model, background, probability=True).collect():
        assert 0 < r.output < 1 and r.base_value + sum(r[f] for f in NAMES) == pytest.approx(r.output, abs=1e-9)


SPACE = {"c": ("log", 1e-6, 1e2), "ratio": ("float", 0.0, 1.0), "depth": ("int", 2, 12), "kind": [0.0, 1.0, 2.0]}


def surface(p):
    return -((math.log10(p["c"]) + 1) / 3) ** 2 - 4 * (p["ratio"] - 0.3) ** 2 - ((p["depth"] - 7) / 4) ** 2 - 0.3 * (p["kind"] != 1.0)


def test_search_beats_random_draws():
    wins = 0
    for seed in range(10):
        found = run(Study(SPACE, seed), lambda p, share: surface(p), 60)
        rng = random.Random(1000 + seed)
        draws = [{"c": 10 ** rng.uniform(-6, 2), "ratio": rng.random(), "depth": rng.randint(2, 12), "kind": rng.choice([0.0, 1.0, 2.0])} for _ in range(60)]
        wins += found.best["value"] > max(map(surface, draws))
    assert wins >= 9


def test_search_is_seeded_stops_bad_trials_and_resumes(spark):
    def measure(p, share):
        return surface(p) - (1 - share)

    whole = run(Study(SPACE, 3, startup=6), measure, 25, (0.25, 0.5, 1.0), 3.0)
    assert whole.trials == run(Study(SPACE, 3, startup=6), measure, 25, (0.25, 0.5, 1.0), 3.0).trials
    states = [t["state"] for t in whole.trials]
    assert states.count("pruned") >= 5 and all((len(t["history"]) == 3) == (t["state"] == "complete") for t in whole.trials)
    part = run(Study(SPACE, 3, startup=6), measure, 11, (0.25, 0.5, 1.0), 3.0)
    again = run(Study(SPACE, 3, startup=6).resumed(part.table(spark)), measure, 25, (0.25, 0.5, 1.0), 3.0)
    assert again.trials == whole.trials
    x = np.linspace(0, 1, 4001)
    assert np.exp(Parzen([0.1, 0.15, 0.9]).log_density(x)).mean() == pytest.approx(1, abs=1e-3)
