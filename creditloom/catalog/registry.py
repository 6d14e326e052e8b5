"""Query registry."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from creditloom.functions.naming import quoted

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register `fn(spark, sf_dir)`; `sql` gives the same rows on the same tables."""
    def keep(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def settled(df: DataFrame, decimals: int = 6) -> DataFrame:
    """Round doubles so that summation order does not show; variances, being large, to single precision."""
    def column(f: T.StructField) -> str:
        c = quoted(f.name)
        if not isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            return c
        return f"double(float(round({c}, 9))) AS {c}" if f.name.endswith("_VAR") else f"round({c}, {decimals}) AS {c}"

    return df.selectExpr(*[column(f) for f in df.schema])
