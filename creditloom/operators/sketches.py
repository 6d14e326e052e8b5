"""Quantile sketches as stored states, for box plots that answer without reading the rows again.

A state holds, per group and feature, the count, the extremes and a KLL sketch of the known values. States of batches merge to the state of
all rows, so one table of them serves every choice of groups and batches. Quantiles of merged sketches are approximate: `rank_error`
states by how much the rank may be off. Groups of up to about `size` values are exact. `ordered.exact_quantiles` is exact at any size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.naming import quoted
from creditloom.session import small_side

SIZE = 1024
_QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def rank_error(size: int = SIZE) -> float:
    """Error of a rank, as a share of the rows, that a quantile of a KLL sketch of this size keeps with 99 % confidence."""
    return 2.296 / size ** 0.9021  # fixed values: the published fit for single quantiles


def _part(feature: str, part: str) -> Column:
    return F.col(quoted(f"{feature}#{part}"))


def states(df: DataFrame, by: Sequence[str], features: Sequence[str], size: int = SIZE) -> DataFrame:
    """One state per group from rows; NULL and NaN count as missing. Combines map-side, so a large group costs one state per task."""
    aggregates = []
    for f in features:
        value = F.nullif(F.col(quoted(f)).cast("double"), F.lit(float("nan")))
        aggregates += [F.count(value).alias(f"{f}#n"), F.min(value).alias(f"{f}#low"), F.max(value).alias(f"{f}#high"),
                       F.kll_sketch_agg_double(value, F.lit(size)).alias(f"{f}#kll")]
    return df.groupBy(*by).agg(*aggregates)


def merged(parts: DataFrame, by: Sequence[str], features: Sequence[str], size: int = SIZE) -> DataFrame:
    """One state per group from any number of states."""
    aggregates = []
    for f in features:
        aggregates += [F.sum(_part(f, "n")).alias(f"{f}#n"), F.min(_part(f, "low")).alias(f"{f}#low"), F.max(_part(f, "high")).alias(f"{f}#high"),
                       F.kll_merge_agg_double(_part(f, "kll"), F.lit(size)).alias(f"{f}#kll")]
    return parts.groupBy(*by).agg(*aggregates)


def quantile(feature: str, p: float) -> Column:
    """The value at rank `p` of a state; NULL for a group without known values."""
    return F.when(_part(feature, "n") > 0, F.kll_sketch_get_quantile_double(_part(feature, "kll"), F.lit(p)))


def boxes(state: DataFrame, by: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(by, feature, n, low, q1, median, q3, high, lower, upper) with 1.5 IQR fences, one row per group and feature."""
    rows = F.array(*[F.struct(
        F.lit(f).alias("feature"), _part(f, "n").alias("n"), _part(f, "low").alias("low"), _part(f, "high").alias("high"),
        *[quantile(f, p).alias(name) for name, p in _QUARTILES.items()]) for f in features])
    long = state.select(*by, F.explode(rows).alias("b")).select(*by, "b.*")
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    return long.select(*by, "feature", "n", "low", "q1", "median", "q3", "high", (F.col("q1") - spread).alias("lower"), (F.col("q3") + spread).alias("upper"))


def rank_gaps(df: DataFrame, found: DataFrame, by: str, feature: str) -> DataFrame:
    """(by, n, q1, median, q3): by how much the rank of each found quartile misses its share of the rows. One pass; `found` are the boxes of one feature."""
    at = found.select(F.col(by).alias("_by"), *[F.col(q).alias(f"_{q}") for q in _QUARTILES])
    value = F.nullif(F.col(quoted(feature)).cast("double"), F.lit(float("nan")))
    known = df.select(by, value.alias("_v")).filter(F.col("_v").isNotNull())
    joined = known.join(small_side(at), F.col(by).eqNullSafe(F.col("_by")))

    def gap(q: str, p: float) -> Column:
        # A tie covers a range of ranks; the share may lie anywhere in it.
        below, upto = F.count_if(F.col("_v") < F.col(f"_{q}")), F.count_if(F.col("_v") <= F.col(f"_{q}"))
        n = F.count(F.lit(1))
        return F.greatest(below / n - p, p - upto / n, F.lit(0.0)).alias(q)

    return joined.groupBy(by).agg(F.count(F.lit(1)).alias("n"), *[gap(q, p) for q, p in _QUARTILES.items()])
