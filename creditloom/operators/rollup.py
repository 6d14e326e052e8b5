"""Spec-driven roll-up of a child table to one row per parent key.

One `groupBy().agg()` computes numeric measures, category shares and every status subset: a subset
is a conditional aggregate, so no filter-aggregate-join-back is needed. All functions except
`nunique` combine map-side, which keeps a key that owns a third of the rows harmless.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.functions.naming import quoted, sql_literal

# Expressions are SQL text: one call into the JVM per output column instead of one per operator,
# which matters for tables of several hundred columns.
_NUMERIC = {
    "min": "min({})",
    "max": "max({})",
    "mean": "avg({})",
    "sum": "sum({})",
    "var": "var_samp({})",
    "nunique": "count(DISTINCT {})",
}


@dataclass(frozen=True)
class Rollup:
    """What to compute per key.

    measures    column -> functions among min, max, mean, sum, var, nunique, size
    categories  column -> category values; None stands for the missing category
    subsets     name prefix -> SQL predicate; the measures are repeated on the matching rows
    count_as    name of an extra group-size column
    """

    prefix: str
    measures: Mapping[str, Sequence[str]]
    categories: Mapping[str, Sequence[object]] = field(default_factory=dict)
    category_funcs: Sequence[str] = ("mean",)
    subsets: Mapping[str, str] = field(default_factory=dict)
    count_as: str | None = None

    def columns(self) -> list[Column]:
        out = [_measure(self.prefix, c, f, None) for c, fs in self.measures.items() for f in fs]
        for c, values in self.categories.items():
            for v in values:
                out += [_share(self.prefix, c, v, f) for f in self.category_funcs]
        out += self.subset_columns()
        if self.count_as:
            out.append(F.count(F.lit(1)).alias(self.count_as))
        return out

    def subset_columns(self) -> list[Column]:
        return [_measure(prefix, c, f, predicate)
                for prefix, predicate in self.subsets.items() for c, fs in self.measures.items() for f in fs]


def dummy_name(column: str, value: object) -> str:
    return f"{column}_{'nan' if value is None else value}"


def is_category(column: str, value: object) -> str:
    """SQL predicate of one category; None tests for the missing one."""
    return f"{quoted(column)} IS NULL" if value is None else f"{quoted(column)} = {sql_literal(value)}"


def _measure(prefix: str, column: str, func: str, predicate: str | None) -> Column:
    name = quoted(f"{prefix}{column}_{func.upper()}")
    if func == "size":
        # An empty subset has no size, as after a left join.
        text = "count(1)" if predicate is None else f"nullif(count_if({predicate}), 0)"
    else:
        text = _NUMERIC[func].format(quoted(column) if predicate is None else f"CASE WHEN {predicate} THEN {quoted(column)} END")
    return F.expr(f"{text} AS {name}")


def _share(prefix: str, column: str, value: object, func: str) -> Column:
    # NULL rows count as 0, so the flag needs its ELSE.
    flag = f"CASE WHEN {is_category(column, value)} THEN 1 ELSE 0 END"
    name = quoted(f"{prefix}{dummy_name(column, value)}_{func.upper()}")
    # sum / count shares the one count(1) buffer across all categories; avg would add one each.
    text = f"sum({flag}) / count(1)" if func == "mean" else _NUMERIC[func].format(flag)
    return F.expr(f"{text} AS {name}")


def rollup(df: DataFrame, key: str | Sequence[str], spec: Rollup) -> DataFrame:
    return df.groupBy(*([key] if isinstance(key, str) else key)).agg(*spec.columns())


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Columns of a numeric type, in schema order."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def columns_of(df: DataFrame, kind: str, exclude: Sequence[str] = ()) -> list[str]:
    """Column names by kind: string, nonstring, float, number or bool."""
    tests = {
        "string": lambda t: isinstance(t, T.StringType),
        "nonstring": lambda t: not isinstance(t, T.StringType),
        "float": lambda t: isinstance(t, (T.DoubleType, T.FloatType)),
        "integer": lambda t: isinstance(t, T.IntegralType),
        "number": lambda t: isinstance(t, T.NumericType),
        "bool": lambda t: isinstance(t, T.BooleanType),
    }
    return [f.name for f in df.schema if tests[kind](f.dataType) and f.name not in exclude]
