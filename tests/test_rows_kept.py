"""Missing and repeated keys, missing scores, outliers and constant columns lose no row and crash nothing."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.operators import collinearity, explain, models, neighbours, ordered, profiling, resampling, splitting


def keyed(spark, width):
    rows = [(None if i % 10 == 0 else (5 if i < 4 else i), i % 2, float(i)) for i in range(102)]
    df = spark.createDataFrame(rows, "k int, y int, v double")
    return df.select("*", *[F.lit(j).alias(f"w{j}") for j in range(width)])


@pytest.mark.parametrize("width", [0, 10])
def test_splits_keep_null_and_repeated_keys(spark, width):
    df = keyed(spark, width)
    split = splitting.stratified_split(df, "k", "y", 0.25)
    got = {r.y: (r.n, r.s) for r in split.groupBy("y").agg(F.count("*").alias("n"), F.sum("in_sample").alias("s")).collect()}
    assert got == {0: (51, 13), 1: (51, 13)}
    folds = splitting.stratified_folds(df, "k", "y", 5).groupBy("y", "fold").count().collect()
    assert len(folds) == 10 and {r["count"] for r in folds} <= {10, 11}
    again = splitting.stratified_split(df.repartition(5), "k", "y", 0.25)
    assert sorted(map(str, split.select("v", "in_sample").collect())) == sorted(map(str, again.select("v", "in_sample").collect()))


@pytest.mark.parametrize("ascending", [True, False])
def test_running_totals_at_every_size(spark, ascending):
    rows = [(g, s, n) for g in ("a", None) for n, s in enumerate([None, float("-inf"), float("inf"), float("nan"), *[x / 7 for x in range(500)]], 1)]
    df = spark.createDataFrame(rows, "g string, s double, n int")
    short, cut = ({(r.g, r.n): (r.before_n, r.cum_n, r.all_n) for r in ordered.running_totals(df, "s", ["n"], ["g"], ascending, size).collect()} for size in (10**6, 100))
    assert len(short) == len(rows) and short == cut


def test_neighbours_of_an_outlier(spark):
    rows = [(i, [float(i % 10), float(i // 10)]) for i in range(100)] + [(1000, [1e6, 1e6])]
    points = spark.createDataFrame(rows, "id long, vec array<double>")
    got = {(r.id, r.place): r.distance for r in neighbours.nearest_neighbours(points, 3, "id", block_rows=20).collect()}
    x = np.array([r[1] for r in rows])
    for i, (key, _) in enumerate(rows):
        want = np.sort(np.delete(np.sqrt(((x - x[i]) ** 2).sum(1)), i))[:3]
        assert [got[key, p] for p in (1, 2, 3)] == pytest.approx(want.tolist())


def test_too_small_a_minority_is_told(spark):
    df = spark.createDataFrame([(i, int(i == 0), float(i)) for i in range(30)], "SK_ID_CURR long, TARGET int, a double")
    with pytest.raises(ValueError, match="minority"):
        resampling.synthetic_minority(df, ["a"], "TARGET")


def test_penalty_follows_the_fitted_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * x))).astype(int)
    df = spark.createDataFrame([(i, int(b), float(a)) for i, (a, b) in enumerate(zip(x, y))], "SK_ID_CURR long, TARGET int, a double")
    coefficient = models.logistic(["a"], c=1.0, max_iter=100).fit(df).stages[-1].coefficients[0]
    # Newton steps of the summed loss with the penalty w²/2.
    lo, hi = x.min(), x.max()
    scaled = [(x - lo) / (hi - lo), (x - x.mean()) / x.std(ddof=1), (x - x.mean()) / x.std()]
    answers = []
    for z in scaled:
        d, w = np.c_[z, np.ones(400)], np.zeros(2)
        for _ in range(50):
            p = 1 / (1 + np.exp(-d @ w))
            w = w - np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + np.diag([1.0, 0.0]), d.T @ (p - y) + np.array([w[0], 0.0]))
        answers.append(w[0])
    assert min(abs(coefficient - a) for a in answers) < 1e-2


def test_vif_with_a_constant_column(spark):
    df = spark.range(200).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2 + F.rand(1)).alias("b"), F.lit(3.0).alias("c"), F.rand(2).alias("d"))
    table = {r.feature: r.vif for r in collinearity.vif_table(df, ["a", "b", "c", "d"]).collect()}
    assert table["c"] == 1.0 and table["a"] > 1000 and table["d"] < 2
    assert len(collinearity.VifSelector(["a", "b", "c", "d"]).fit(df).removed) == 1


def test_background_keeps_gaps_and_ranges_are_true(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, 2.0), (3, None, None)], "SK_ID_CURR long, a double, b double")
    assert len(explain.background_rows(df, ["a", "b"])) == 2
    narrow = {r.feature: r.target_type for r in profiling.narrow_plan(spark.createDataFrame([(-20_000, -1e5, 2**40)], "i long, f double, j long")).collect()}
    assert narrow == {"i": "int", "f": "float", "j": "bigint"}
