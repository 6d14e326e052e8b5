"""Population analysis: shares, histograms, box statistics and filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.operators.ordered import exact_quantiles
from creditloom.operators.profiling import column_roles
from creditloom.session import small_side


def with_share(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Add `share` = n / total within `by`. Without `by` the total is a scalar aggregate, so that many categories never meet in one
    task; with `by` a window runs over the counted bins of a group."""
    total = F.sum("n").over(Window.partitionBy(*by)) if by else counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.try_divide(F.col("n").cast("double"), total.cast("double")))


def class_ratio(df: DataFrame, target: str) -> DataFrame:
    """(target, n, share)."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return with_share(counts)


def category_share(df: DataFrame, feature: str, client_value: object = None) -> DataFrame:
    """(feature, n, share, is_client): category counts with the client's own category flagged."""
    counts = df.filter(F.col(feature).isNotNull()).groupBy(feature).agg(F.count(F.lit(1)).alias("n"))
    own = (F.col(feature) == F.lit(client_value)).cast("int") if client_value is not None else F.lit(0)
    return with_share(counts).withColumn("is_client", F.coalesce(own, F.lit(0)))


def _bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    width = (high - low) / bins
    place = F.floor(F.try_divide(value - low, width))
    return F.least(F.greatest(F.coalesce(place, F.lit(0)), F.lit(0)), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, feature: str, bins: int = 50, by: Sequence[str] = ()) -> DataFrame:
    """(by, bin, n, bin_start, percent): equal-width bins over the whole range, percent within `by`."""
    by = list(by)
    known = df.select(*by, F.col(feature).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    bounds = known.agg(F.struct(F.min("_v").alias("low"), F.max("_v").alias("high"))).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    counts = known.groupBy(*by, _bin(F.col("_v"), low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    out = with_share(counts, by)
    return out.select(*by, "bin", "n", (low + F.col("bin") * ((high - low) / bins)).alias("bin_start"),
                      (F.col("share") * 100).alias("percent"))


def mean_position(df: DataFrame, key: str, feature: str) -> DataFrame:
    """Each client against the population mean: (key, value, mean_value, above_mean)."""
    value = F.col(feature).cast("double")
    mean = df.agg(F.avg(value)).scalar()
    return df.select(key, value.alias("value"), mean.alias("mean_value"), (value > mean).cast("int").alias("above_mean"))


def box_stats(df: DataFrame, feature: str, category: str) -> DataFrame:
    """(category, n, q1, median, q3, iqr, lower, upper) with 1.5 IQR fences."""
    q = exact_quantiles(df, [feature], [0.25, 0.5, 0.75], [category])
    iqr = F.col("q2") - F.col("q0")
    return q.select(category, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"),
                    iqr.alias("iqr"), (F.col("q0") - 1.5 * iqr).alias("lower"), (F.col("q2") + 1.5 * iqr).alias("upper"))


def outlier_flags(df: DataFrame, stats: DataFrame, key: str, feature: str, category: str) -> DataFrame:
    """Every client against the box of its category: (key, category, value, median, is_outlier, above_median).

    `stats` has one row per category, so clients stay where they are even if one category holds most.
    """
    value = F.col(feature).cast("double")
    boxes = small_side(stats.select(category, "median", "lower", "upper"))
    out = df.select(key, category, value.alias("value")).join(boxes, category, "left")
    return out.select(
        key, category, "value", "median",
        ((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))).cast("int").alias("is_outlier"),
        (F.col("value") > F.col("median")).cast("int").alias("above_median"))


def filter_predicate(feature: str, wanted: object) -> Column:
    """A (low, high) pair keeps the closed range, a list keeps its members."""
    if isinstance(wanted, tuple):
        return F.col(feature).between(*wanted)
    return F.col(feature).isin(*wanted)


def filter_roles(df: DataFrame, features: Sequence[str]) -> dict[str, str]:
    """numeric (more than 5 distinct values: range filter) or categorical (member filter)."""
    return {r["feature"]: r["role"] for r in column_roles(df, features, limit=5).collect()}


def filter_steps(df: DataFrame, filters: Mapping[str, object]) -> DataFrame:
    """(step, feature, n_rows): rows left after each filter, all steps counted in one aggregate."""
    keep, counts = F.lit(True), [F.count(F.lit(1)).alias("_0")]
    for i, (feature, wanted) in enumerate(filters.items(), start=1):
        keep = keep & filter_predicate(feature, wanted)
        counts.append(F.count(F.when(keep, 1)).alias(f"_{i}"))
    names = ["", *filters]
    wide = df.agg(*counts)
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("step"), F.lit(n).alias("feature"), F.col(f"_{i}").alias("n_rows"))
                               for i, n in enumerate(names)]))
    return wide.select(rows.alias("r")).select("r.*")


def chained_filter(df: DataFrame, filters: Mapping[str, object], min_sample_size: int = 50) -> tuple[DataFrame, list[str]]:
    """Apply filters in order while at least `min_sample_size` rows remain before each one."""
    left = {r["step"]: r["n_rows"] for r in filter_steps(df, filters).collect()}
    used: list[str] = []
    for i, (feature, wanted) in enumerate(filters.items()):
        if left[i] < min_sample_size:
            break
        df = df.filter(filter_predicate(feature, wanted))
        used.append(feature)
    return df, used


def value_labels(c: Column, labels: Mapping[object, str]) -> Column:
    """Readable label of a coded value, NULL when the code is unknown."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


# Readable labels of coded features.
LABELS = {
    "CODE_GENDER": {1: "Female", 0: "Male", -1: "XNA"},
    "NAME_EDUCATION_TYPE_Highereducation": {0: "No", 1: "Higher education"},
    "NAME_FAMILY_STATUS_Married": {0: "Not married", 1: "Married"},
    "PREDICTION": {0: "Crédit Accordé", 1: "Crédit Refusé"},
}
