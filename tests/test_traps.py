"""Hand-made frames for null, ratio, category and naming rules."""

import math

import pytest
from pyspark.sql import functions as F

from creditloom.functions.columns import clip_lower, decision, finite, hm, hms, ratio, recode, sentinel_to_null
from creditloom.functions.naming import clean_names, search_names
from creditloom.operators import cleaning, encoding, profiling
from creditloom.operators.rollup import Rollup, rollup
from creditloom.plans.specs import APPLICATION_CODES


def one(df):
    return df.first()[0]


def test_dummy_mean_counts_null_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, None)], "k int, c string")
    row = rollup(df, "k", Rollup("P_", {}, {"c": ["a", "b", None]})).first()
    assert [row["P_c_a_MEAN"], row["P_c_b_MEAN"], row["P_c_nan_MEAN"]] == pytest.approx([1 / 3] * 3)


def test_zero_denominator_default_and_strict(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0), (4.0, 2.0)], "n double, d double")
    lenient = df.select(ratio(F.col("n"), F.col("d")).alias("r"))
    assert sorted((r["r"] for r in lenient.collect()), key=str) == [2.0, None, None]
    assert lenient.agg(F.avg("r")).first()[0] == 2.0
    strict = df.select(ratio(F.col("n"), F.col("d"), strict_inf=True).alias("r"))
    assert strict.agg(F.avg("r")).first()[0] == math.inf
    assert strict.agg(finite(F.avg("r"))).first()[0] is None
    assert strict.agg(finite(F.min("r"))).first()[0] == 2.0


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-3,), (5,)], "x int")
    assert sorted((r[0] for r in df.select(clip_lower(F.col("x"))).collect()), key=str) == [0, 5, None]


def test_single_row_variance_is_null(spark):
    df = spark.createDataFrame([(1, 2.0)], "k int, x double")
    assert rollup(df, "k", Rollup("", {"x": ["var"]})).first()["x_VAR"] is None


def test_size_and_nunique(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (1, 2.0)], "k int, x double")
    row = rollup(df, "k", Rollup("", {"x": ["size", "nunique", "sum"]}, count_as="N")).first()
    assert (row["x_SIZE"], row["x_NUNIQUE"], row["x_SUM"], row["N"]) == (3, 1, 4.0, 3)


def test_subset_equals_filter_then_join(spark):
    df = spark.createDataFrame([(1, "A", 2.0), (1, "B", 3.0), (2, "B", None), (3, "A", None)], "k int, s string, x double")
    spec = Rollup("", {"x": ["sum", "size", "mean"]}, subsets={"A_": "s = 'A'"})
    got = {r["k"]: (r["A_x_SUM"], r["A_x_SIZE"], r["A_x_MEAN"]) for r in rollup(df, "k", spec).collect()}
    assert got == {1: (2.0, 1, 2.0), 2: (None, None, None), 3: (None, 1, None)}


def test_sentinel_recode_and_decision(spark):
    df = spark.createDataFrame([(365243, "N", 0.48), (-100, "Y", 0.5), (None, None, 0.1)], "d int, o string, p double")
    rows = df.select(sentinel_to_null(F.col("d")), recode(F.col("o"), APPLICATION_CODES["FLAG_OWN_REALTY"]),
                     decision(F.col("p"), 0.48), decision(F.col("p"), 0.48, inclusive=True)).collect()
    assert [tuple(r) for r in rows] == [(None, 1, 0, 1), (-100, 0, 1, 1), (None, None, 0, 0)]


def test_clean_names_and_collision(spark):
    assert clean_names(spark.createDataFrame([(1,)], "`Higher education` int")).columns == ["Highereducation"]
    with pytest.raises(ValueError, match="both clean to"):
        clean_names(spark.createDataFrame([(1, 2)], "`A-B` int, AB int"))
    assert search_names(["Date", "price", "x"], "^da|PRICE") == ["Date", "price"]
    assert search_names(["Date", "date"], "^d", case_sensitive=True) == ["date"]


def test_durations(spark):
    df = spark.createDataFrame([(59.6,), (3661.0,), (90061.0,)], "s double")
    assert [tuple(r) for r in df.select(hms(F.col("s")), hm(F.col("s"))).collect()] == [
        ("0:01:00", "00:01"), ("1:01:01", "01:01"), ("1 day, 1:01:01", "25:01")]


def test_category_limit_is_an_error(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("c"))
    with pytest.raises(ValueError, match="more than 10"):
        encoding.category_dictionary(df, max_categories=10)


def test_category_values_are_quoted(spark):
    df = spark.createDataFrame([(1, "it's \\ odd"), (1, "b")], "k int, c string")
    spec = Rollup("", {}, encoding.category_dictionary(df))
    assert rollup(df, "k", spec).first()["c_it's \\ odd_MEAN"] == 0.5


def test_align_creates_missing_as_zero(spark):
    df = spark.createDataFrame([(7, 1.5, "x")], "SK_ID_CURR int, A double, EXTRA string")
    assert cleaning.align(df, ["A", "B"]).first().asDict() == {"SK_ID_CURR": 7, "A": 1.5, "B": 0}
    assert cleaning.type_mismatch(["A", "B"], {"A": "double", "C": "int"}) == (["C"], ["B"])


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1, None, 1.0), (1, None, 2.0)], "c int, e double, v double")
    assert profiling.low_variance(df, ["c", "e", "v"]) == ["c"]
    assert {r["feature"] for r in profiling.empty_columns(df).filter("is_empty = 1").collect()} == {"e"}
    with pytest.raises(ValueError, match="'e'"):
        profiling.null_guard(df)


def test_infinite_and_nan_become_null(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.0,)], "x double")
    assert profiling.infinite_columns(df).first()["n_infinite"] == 1
    assert cleaning.infinities_to_null(df).agg(F.count("x")).first()[0] == 1


def test_column_roles_counts_exactly(spark):
    df = spark.range(1000).select((F.col("id") % 4).alias("four"), (F.col("id") % 5).alias("five"), "id")
    roles = {r["feature"]: r["role"] for r in profiling.column_roles(df, ["four", "five", "id"]).collect()}
    assert roles == {"four": "categorical", "five": "numeric", "id": "numeric"}
