"""Column profiles. Each profile of all columns is one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.naming import quoted, sql_literal
from creditloom.operators.cleaning import cast_columns
from creditloom.operators.ordered import exact_quantiles
from creditloom.operators.rollup import columns_of

# Missing-rate bands in percent.
LOW_MISSING = 30
FULL_MISSING = 100


def per_column(df: DataFrame, columns: Sequence[str], value: Callable[[str], str], into: str) -> DataFrame:
    """(feature, value) rows; `value` maps a quoted column name to an SQL aggregate."""
    return per_column_structs(df, columns, lambda c: {into: value(c)})


def per_column_structs(df: DataFrame, columns: Sequence[str], fields: Callable[[str], Mapping[str, str]]) -> DataFrame:
    """One row per column: `feature` and the named SQL aggregates of `fields(quoted column)`.

    All columns go through one aggregate over one scan.
    """
    columns = list(columns)
    if not columns:
        raise ValueError("no columns to profile")
    cells = []
    for c in columns:
        parts = ", ".join(f"{sql_literal(n)}, {text}" for n, text in fields(quoted(c)).items())
        cells.append(f"named_struct('feature', {sql_literal(c)}, {parts})")
    # Aggregate first and explode after: a generator may not hold aggregates.
    wide = df.agg(*[F.expr(f"{cell} AS _{i}") for i, cell in enumerate(cells)])
    return wide.selectExpr(f"inline(array({', '.join(f'_{i}' for i in range(len(cells)))}))")


def missing_pct(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, missing_pct)."""
    return per_column(df, list(columns or df.columns), lambda c: f"try_divide((count(1) - count({c})) * 100D, double(count(1)))",
                      "missing_pct")


def missing_band(pct: Column) -> Column:
    return F.when(pct <= LOW_MISSING, "bottom").when(F.round(pct, 1) >= FULL_MISSING, "top").otherwise("middle")


def missing_bands(missing: DataFrame) -> DataFrame:
    """(band, n_features, max_pct)."""
    return missing.groupBy(missing_band(F.col("missing_pct")).alias("band")).agg(
        F.count(F.lit(1)).alias("n_features"), F.max("missing_pct").alias("max_pct"))


def most_missing(missing: DataFrame, n: int, by: str = "value") -> DataFrame:
    """The n most missing features, or the first n by name."""
    order = [F.col("feature").asc()] if by == "index" else [F.col("missing_pct").desc(), F.col("feature").asc()]
    return missing.orderBy(*order).limit(n)


def variances(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, variance): sample variance, booleans as 0/1."""
    return per_column(df, columns, lambda c: f"var_samp(double({c}))", "variance")


def low_variance(df: DataFrame, columns: Sequence[str], threshold: float = 0.0) -> list[str]:
    """Names whose variance does not exceed the threshold (unknown variance does not count)."""
    found = variances(df, columns).filter(F.col("variance") <= threshold).collect()
    return [r["feature"] for r in found]


def empty_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(feature, is_empty): 1 when the column holds no value at all."""
    return per_column(df, list(columns or df.columns), lambda c: f"int(count({c}) = 0)", "is_empty")


def infinite_columns(df: DataFrame) -> DataFrame:
    """(feature, n_infinite) of the floating columns that hold ±inf."""
    counted = per_column(df, columns_of(df, "float"), lambda c: f"count_if(abs({c}) = double('Infinity'))", "n_infinite")
    return counted.filter(F.col("n_infinite") > 0)


def null_guard(df: DataFrame) -> None:
    """Raise when a column holds NULL, naming the columns."""
    bad = [r["feature"] for r in missing_pct(df).filter(F.col("missing_pct") > 0).collect()]
    if bad:
        raise ValueError(f"remove missing values first, {len(bad)} columns have some: {sorted(bad)}")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """(key, n_rows) of keys that occur more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def min_max(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, min_value, max_value)."""
    return per_column_structs(df, columns, lambda c: {"min_value": f"double(min({c}))", "max_value": f"double(max({c}))"})


# The ranges of the 32-bit types, inside which they are taken.
INT_RANGE = (-2147483648, 2147483647)
FLOAT_RANGE = (-3.4028234663852886e38, 3.4028234663852886e38)


def narrow_plan(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """(feature, min_value, max_value, target_type) for every integer and floating column."""
    ints, floats = columns_of(df, "integer", exclude), columns_of(df, "float", exclude)
    bounds = min_max(df, [*ints, *floats])

    def fits(low: float, high: float) -> Column:
        return (F.col("min_value") >= low) & (F.col("max_value") <= high)

    whole = F.col("feature").isin(ints) if ints else F.lit(False)
    target = F.when(whole, F.when(fits(*INT_RANGE), "int").otherwise("bigint")) \
        .otherwise(F.when(fits(*FLOAT_RANGE), "float").otherwise("double"))
    return bounds.withColumn("target_type", target)


def narrow(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """Cast to the types of `narrow_plan`."""
    types = {r["feature"]: r["target_type"] for r in narrow_plan(df, exclude).collect()}
    return cast_columns(df, types)


def binary_features(df: DataFrame, exclude: Sequence[str] = ("SK_ID_CURR", "TARGET")) -> DataFrame:
    """(feature, is_binary): boolean columns, and numeric ones whose known values are all 0 or 1."""
    columns = [*columns_of(df, "number", exclude), *columns_of(df, "bool", exclude)]
    return per_column(df, columns, lambda c: f"int(count_if(double({c}) NOT IN (0D, 1D)) = 0)", "is_binary")


# Aggregate suffixes that stay numeric.
KEEP_NUMERIC = ("_SUM", "_MIN", "_MAX")


def binary_to_bool(df: DataFrame, exclude: Sequence[str] = ("SK_ID_CURR", "TARGET")) -> DataFrame:
    """Cast 0/1 columns to boolean unless the name says they are an aggregate."""
    found = {r["feature"] for r in binary_features(df, exclude).filter("is_binary = 1").collect()
             if not r["feature"].endswith(KEEP_NUMERIC)}
    return cast_columns(df, {c: "boolean" for c in found})


def column_roles(df: DataFrame, columns: Sequence[str], limit: int = 4) -> DataFrame:
    """(feature, role): numeric above `limit` distinct values, else categorical.

    A sketch clears the columns that are far above the limit; only the rest, which have few values
    and so combine map-side, are counted exactly.
    """
    sketch = df.agg(*[F.approx_count_distinct(F.col(c), 0.05).alias(c) for c in columns]).first().asDict()
    near = [c for c in columns if sketch[c] <= 10 * (limit + 1)]
    far = [c for c in columns if c not in near]
    spark = df.sparkSession
    known = spark.createDataFrame([(c, limit + 1) for c in far], "feature string, n bigint")
    if near:
        cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("v")) for c in near]))
        exact = df.select(cells.alias("c")).select("c.*").distinct().groupBy("feature").agg(F.count("v").alias("n"))
        known = known.unionByName(exact)
    return known.select("feature", F.when(F.col("n") > limit, "numeric").otherwise("categorical").alias("role"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, count, mean, std, min, q25, median, q75, max) with exact quartiles."""
    basic = per_column_structs(df, columns, lambda c: {
        "count": f"count({c})", "mean": f"avg({c})", "std": f"stddev_samp(double({c}))",
        "min": f"double(min({c}))", "max": f"double(max({c}))"})
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    return basic.join(quartiles, basic.feature == quartiles.column, "left").select(
        "feature", "count", "mean", "std", "min", F.col("q0").alias("q25"), F.col("q1").alias("median"),
        F.col("q2").alias("q75"), "max")
