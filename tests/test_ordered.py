"""Bucketed ranks, totals and quantiles against plain Python, with groups that hold most rows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import metrics as M
from creditloom.operators import ordered as O
from creditloom.operators import splitting as X


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, a third of the values tied."""
    rng = random.Random(5)
    rows = [(i, "hot" if rng.random() < 0.7 else rng.choice("abc"), 1.25 if rng.random() < 0.34 else rng.gauss(0, 50)) for i in range(6000)]
    return rows, spark.createDataFrame(rows, "id long, g string, v double").repartition(8)


@pytest.mark.parametrize("rows_per_bucket", [200, 10 ** 6])
def test_quantiles(skewed, rows_per_bucket):
    rows, df = skewed
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    got = {r["g"]: r for r in O.exact_quantiles(df, ["v"], probs, ["g"], rows_per_bucket).collect()}
    for g in "abc", "hot":
        for name in ([g] if g == "hot" else list(g)):
            values = [v for _, x, v in rows if x == name]
            assert [got[name][f"q{i}"] for i in range(len(probs))] == pytest.approx(list(np.quantile(values, probs)), abs=1e-9)
            assert got[name]["n"] == len(values)


def test_quantiles_of_several_columns_without_groups(skewed):
    rows, df = skewed
    two = df.withColumn("w", F.when(F.col("id") % 3 > 0, F.col("v") * 1000))
    got = {r["column"]: r["q0"] for r in O.exact_quantiles(two, ["v", "w"], [0.5], rows_per_bucket=300).collect()}
    assert got["v"] == pytest.approx(np.median([v for _, _, v in rows]))
    assert got["w"] == pytest.approx(np.median([v * 1000 for i, _, v in rows if i % 3]))


@pytest.mark.parametrize("rows_per_bucket", [150, 10 ** 6])
@pytest.mark.parametrize("ascending", [True, False])
def test_running_totals(skewed, rows_per_bucket, ascending):
    rows, df = skewed
    per_value = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    out = O.running_totals(per_value, "v", ["n"], ["g"], ascending, rows_per_bucket)
    for r in out.filter("g = 'hot'").collect():
        mine = [v for _, g, v in rows if g == "hot"]
        upto = sum((v <= r["v"]) if ascending else (v >= r["v"]) for v in mine)
        assert (r["cum_n"], r["before_n"], r["all_n"]) == (upto, upto - r["n"], len(mine))


def test_digest_rank_matches_a_full_sort(skewed):
    rows, df = skewed
    got = {r["id"]: (r["rank"], r["stratum_size"]) for r in O.digest_rank(df, "id", ["g"], 42).collect()}
    for g in {r[1] for r in rows}:
        ids = sorted((i for i, x, _ in rows if x == g), key=lambda i: (hashlib.md5(f"{i}-42".encode()).hexdigest(), i))
        assert [got[i] for i in ids] == [(p, len(ids)) for p in range(1, len(ids) + 1)]


def test_split_shares_and_folds(skewed):
    rows, df = skewed
    narrow = X.stratified_split(df, "id", "g", 0.25)
    wide = X.stratified_split(df.withColumns({f"x{i}": F.lit(i) for i in range(10)}), "id", "g", 0.25)
    flags = {r["id"]: r["in_sample"] for r in narrow.collect()}
    assert flags == {r["id"]: r["in_sample"] for r in wide.select("id", "in_sample").collect()}
    for g in {r[1] for r in rows}:
        ids = [i for i, x, _ in rows if x == g]
        assert sum(flags[i] for i in ids) == int(len(ids) * 0.25 + 0.5)
    sizes = [r["count"] for r in X.stratified_folds(df, "id", "g", 5).filter("g = 'hot'").groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_tied_scores_auc(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "y int, p double")
    assert M.roc_auc(M.score_totals(df, "y", "p")).first()["auc"] == pytest.approx(0.875)


def test_bucketed_auc_and_grid_equal_plain(skewed):
    _, df = skewed
    scored = df.select(F.when(F.col("g") == "hot", 1).otherwise(0).alias("y"), F.col("v").alias("p"), (F.col("id") % 2).alias("fold"))
    plain, cut = (M.score_totals(scored, "y", "p", ["fold"], rows_per_bucket=n) for n in (10 ** 6, 100))
    a, b = ({r["fold"]: r["auc"] for r in M.roc_auc(t, ["fold"]).collect()} for t in (plain, cut))
    assert a == pytest.approx(b)
    grids = [{(r["fold"], r["step"]): r["tpr"] for r in M.roc_on_grid(t, ["fold"]).collect()} for t in (plain, cut)]
    assert len(grids[0]) == 200 and grids[0] == pytest.approx(grids[1])


def test_grid_matches_numpy_interp(spark):
    rng = random.Random(3)
    rows = [(int(rng.random() < 0.3), round(rng.random(), 1)) for _ in range(300)]
    df = spark.createDataFrame([(y, p, 0) for y, p in rows], "y int, p double, fold int")
    got = {r["step"]: r["tpr"] for r in M.roc_on_grid(M.score_totals(df, "y", "p", ["fold"]), ["fold"]).collect()}
    pos, neg = sum(y for y, _ in rows), sum(1 - y for y, _ in rows)
    fpr, tpr = [0.0], [0.0]
    for t in sorted({p for _, p in rows}, reverse=True):
        tpr.append(sum(y for y, p in rows if p >= t) / pos)
        fpr.append(sum(1 - y for y, p in rows if p >= t) / neg)
    want = np.interp(np.linspace(0, 1, 100), fpr, tpr)
    want[0] = 0.0
    assert [got[i] for i in range(100)] == pytest.approx(list(want))


def test_best_threshold_and_sweep(spark):
    # A score equal to a threshold of the grid counts as refused; grid values are start + i * step.
    edge = M.thresholds()[28]
    df = spark.createDataFrame([(0, edge, 0), (0, 0.1, 0), (1, 0.7, 0), (1, 0.3, 0)], "y int, p double, fold int")
    sweep = {round(r["threshold"], 2): r for r in M.threshold_sweep(df, "y", "p", "fold").collect()}
    assert len(sweep) == 99
    assert (sweep[0.29]["fp"], sweep[0.3]["fp"], sweep[0.71]["fn"], sweep[0.01]["tn"]) == (1, 0, 2, 0)
    best = M.best_gain(M.sweep_summary(M.threshold_sweep(df, "y", "p", "fold"))).first()
    assert (round(best["best_threshold"], 2), best["best_gain"]) == (0.3, 1.0)


def test_gain_cases(spark):
    def gain(tn, fp, fn, tp):
        return M.with_metrics(spark.createDataFrame([(tn, fp, fn, tp)], "tn long, fp long, fn long, tp long")).first()

    assert gain(92, 0, 0, 8)["business_gain"] == 1.0
    assert gain(0, 92, 8, 0)["business_gain"] == 0.0
    none = gain(92, 0, 8, 0)
    assert none["business_gain"] == pytest.approx(1.84 / 2.72) and (none["recall"], none["precision"], none["f1_score"]) == (0, 0, 0)
