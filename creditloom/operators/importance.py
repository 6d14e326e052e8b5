"""Importance tables: fold statistics, ranks, screens and top-n views."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def stack(tables: Sequence[DataFrame]) -> DataFrame:
    """Per-fold tables under each other."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def fold_importance(per_fold: DataFrame) -> DataFrame:
    """(feature, importance_mean, importance_std): sample deviation over folds."""
    return per_fold.groupBy("feature").agg(F.avg("importance").alias("importance_mean"),
                                           F.stddev_samp("importance").alias("importance_std"))


def ranked(importance: DataFrame, by: str = "importance_mean", into: str = "rank_importance") -> DataFrame:
    """Rank 1 = most important, ties by name. One row per feature, so one window is enough."""
    return importance.withColumn(into, F.row_number().over(
        Window.partitionBy(F.lit(0)).orderBy(F.col(by).desc(), F.col("feature"))))


def with_missing(importance: DataFrame, missing: DataFrame) -> DataFrame:
    """Attach missing_pct; both sides have one row per feature."""
    return importance.join(missing, "feature", "left")


def screened_out(importance: DataFrame, min_rank: int = 300, min_missing: float = 30.0) -> DataFrame:
    """Features to drop: low rank and often missing."""
    return importance.filter((F.col("rank_importance") >= min_rank) & (F.col("missing_pct") > min_missing))


def top(importance: DataFrame, n: int, by: str = "importance", sort_by_name: bool = False) -> DataFrame:
    best = importance.orderBy(F.col(by).desc(), F.col("feature")).limit(n)
    return best.orderBy("feature") if sort_by_name else best


OTHERS = "Somme des Autres caractéristiques"  # fixed value: label of the remainder bar


def top_with_others(importance: DataFrame, n: int, by: str = "importance", label: str = OTHERS) -> DataFrame:
    """(feature, importance): the n greatest and the sum of the rest."""
    place = ranked(importance, by, "_rank")
    name = F.when(F.col("_rank") <= n, F.col("feature")).otherwise(F.lit(label))
    return place.groupBy(name.alias("feature")).agg(F.sum(by).alias(by))


# Direction labels.
TO_REFUSAL = "Tire vers le REFUS du prêt"
TO_APPROVAL = "Tire vers l'ACCORD du prêt"


def with_direction(importance: DataFrame) -> DataFrame:
    return importance.withColumn("impact_direction", F.when(F.col("signed_mean") > 0, TO_REFUSAL).otherwise(TO_APPROVAL))


def name_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """(feature, side): names on one side only."""
    return left.select("feature").exceptAll(right.select("feature")).withColumn("side", F.lit("left")).unionByName(
        right.select("feature").exceptAll(left.select("feature")).withColumn("side", F.lit("right")))
