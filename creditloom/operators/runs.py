"""The table of evaluation runs."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.columns import hms


def merge_prefixed(named: Mapping[str, Column]) -> Column:
    """One map out of several, keys prefixed with `<name>__`."""
    def prefixed(name: str, m: Column) -> Column:
        return F.transform_keys(m, lambda k, _: F.concat(F.lit(f"{name}__"), k))

    return F.map_concat(*[prefixed(n, m) for n, m in named.items()])


def run_record(scores: DataFrame, tags: Mapping[str, str], gains: Mapping[str, float], model_name: str, n_features: int,
               n_rows: int | Column, threshold: float, balancing: str) -> DataFrame:
    """One row: tags, mean scores, gain parameters and model facts. `scores` is (metric, mean)."""
    wide = scores.agg(*[F.max(F.when(F.col("metric") == m, F.col("mean"))).alias(m) for m in (
        "auc", "accuracy", "recall", "f1_score", "business_gain", "tn", "fp", "fn", "tp")])
    rows = n_rows if isinstance(n_rows, Column) else F.lit(n_rows)
    return wide.select(
        *[F.lit(v).alias(k) for k, v in tags.items()], "*", *[F.lit(float(v)).alias(k) for k, v in gains.items()],
        F.lit(model_name).alias("model_name"), F.lit(n_features).alias("n_feat"), rows.cast("bigint").alias("n_rows"),
        F.lit(threshold).alias("threshold"), F.lit(balancing).alias("balancing"))


def append(runs: DataFrame, record: DataFrame) -> DataFrame:
    """Add records at the end; `position` orders the table."""
    last = runs.agg(F.coalesce(F.max("position"), F.lit(0.0))).scalar()
    return runs.unionByName(record.withColumn("position", last + 1.0), allowMissingColumns=True)


def insert_before(runs: DataFrame, record: DataFrame, position: float) -> DataFrame:
    """Add a record between `position` and the row before it."""
    prior = runs.filter(F.col("position") < position).agg(F.coalesce(F.max("position"), F.lit(position - 2.0))).scalar()
    return runs.unionByName(record.withColumn("position", (prior + F.lit(position)) / 2), allowMissingColumns=True)


def drop_run(runs: DataFrame, position: float) -> DataFrame:
    return runs.filter(F.col("position") != position)


def comparison(runs: DataFrame, columns: Sequence[str] | None = None, sort_by: Sequence[str] = (), decimals: int = 4,
               custom: Mapping[str, int] | None = None, durations: Sequence[str] = ("time_fit", "fit_time")) -> DataFrame:
    """Display form: chosen columns, best first, floats as text with fixed decimals, durations as h:mm:ss."""
    from creditloom.operators.narrative import fixed
    from creditloom.operators.rollup import columns_of

    shown = [c for c in (columns or runs.columns) if c in runs.columns]
    ordered = runs.orderBy(*[F.col(c).desc() for c in sort_by]) if sort_by else runs
    floats, custom = set(columns_of(runs, "float")), custom or {}

    def cell(c: str) -> Column:
        if c in custom:
            return fixed(F.col(c), custom[c]).alias(c)
        if c in durations:
            return hms(F.col(c)).alias(c)
        return fixed(F.col(c), decimals).alias(c) if c in floats else F.col(c)

    return ordered.select(*[cell(c) for c in shown])


def scoring_parameters(gains: Mapping[str, float], threshold: float) -> str:
    """JSON of the gain parameters and the threshold."""
    return json.dumps({**gains, "threshold_prob": threshold}, indent=2)
