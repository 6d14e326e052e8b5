"""Merged sketches keep the stated rank error and the exact counts and extremes."""

import pytest
from pyspark.sql import functions as F

from creditloom.operators import partials, sketches
from creditloom.session import scratch_path

KEYS = ["kind"]


def rows(spark, n=60_000):
    """A hot group with ties, a skewed one, one of three values, one of missing values only, and the group NULL."""
    i = F.col("id")
    kind = F.when(i % 3 == 0, "hot").when(i < n - 40, "skewed").when(i < n - 30, "few").when(i < n - 15, "missing")
    value = (F.when(kind == "missing", None).when(i % 97 == 5, float("nan")).when(kind == "hot", F.floor(F.rand(3) * 50))
             .when(kind == "few", i % 3).otherwise(F.exp(F.rand(5) * 20)))
    return spark.range(n).select("id", kind.alias("kind"), value.cast("double").alias("x"), (i % 7).alias("y"))


@pytest.mark.parametrize("size", [64, 1024])
def test_merged_states_keep_the_rank_error(spark, size):
    df, path = rows(spark).persist(), scratch_path(spark, "sketches")
    for b in (0, 1, 2, 2):
        partials.write_batch(sketches.states(df.filter(F.col("id") % 3 == b).unionByName(df.limit(0)), KEYS, ["x", "y"], size), path, str(b))
    whole = sketches.boxes(sketches.merged(partials.read_batches(spark, path), KEYS, ["x", "y"], size), KEYS, ["x", "y"])
    got = {(r.kind, r.feature): r for r in whole.collect()}
    exact = {r.kind: r for r in df.filter(~F.isnan("x")).groupBy("kind").agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()}
    for kind, want in exact.items():
        assert (got[kind, "x"].n, got[kind, "x"].low, got[kind, "x"].high) == (want.n, want.low, want.high)
    assert got["missing", "x"].n == 0 and got["missing", "x"].median is None and got["missing", "y"].n == 10
    # Three times the bound of 99 % confidence: chance does not reach it.
    for r in sketches.rank_gaps(df, whole.filter("feature = 'x'"), "kind", "x").collect():
        assert max(r.q1, r.median, r.q3) <= 3 * sketches.rank_error(size)
    assert got["few", "x"].median in (0.0, 1.0, 2.0) and got[None, "x"].n > 0


def test_small_groups_are_exact_and_no_rows_give_none(spark):
    df = spark.createDataFrame([("a", float(v)) for v in range(1, 102)], "kind string, x double")
    box = sketches.boxes(sketches.states(df, KEYS, ["x"]), KEYS, ["x"]).first()
    assert (box.low, box.median, box.high, box.n) == (1.0, 51.0, 101.0, 101) and box.lower < 0 < 102 < box.upper
    assert sketches.boxes(sketches.merged(sketches.states(df.limit(0), KEYS, ["x"]), KEYS, ["x"]), KEYS, ["x"]).isEmpty()
