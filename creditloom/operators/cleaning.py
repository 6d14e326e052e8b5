"""Alignment, casts and screens applied to a finished feature table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.columns import finite
from creditloom.functions.naming import quoted
from creditloom.operators.rollup import columns_of


def infinities_to_null(df: DataFrame) -> DataFrame:
    floats = set(columns_of(df, "float"))

    def column(c: str) -> str:
        q = quoted(c)
        return f"CASE WHEN NOT isnan({q}) AND abs({q}) != double('Infinity') THEN {q} END AS {q}" if c in floats else q

    return df.selectExpr(*[column(c) for c in df.columns])


def align(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ("SK_ID_CURR",)) -> DataFrame:
    """Exactly the training features: extras go, absent ones are created as 0, keys stay."""
    have = set(df.columns)
    return df.select(*[c for c in keep if c in have],
                     *[F.col(f) if f in have else F.lit(0).alias(f) for f in features])


def type_mismatch(features: Sequence[str], types: Mapping[str, str]) -> tuple[list[str], list[str]]:
    """Names with a type but no feature, and features without a type."""
    return [t for t in types if t not in features], [f for f in features if f not in types]


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast by a {column: type} dictionary; other columns pass."""
    return df.selectExpr(*[
        f"CAST({quoted(c)} AS {types[c]}) AS {quoted(c)}" if c in types else quoted(c) for c in df.columns])


def for_modelling(df: DataFrame, exclude: Sequence[str] = ("SK_ID_CURR", "TARGET")) -> DataFrame:
    """Integers to double, then booleans to int: what a fitted model may be given."""
    ints, bools = columns_of(df, "integer", exclude), columns_of(df, "bool", exclude)
    return cast_columns(df, {**{c: "double" for c in ints}, **{c: "int" for c in bools}})


def predictors(df: DataFrame, exclude: Sequence[str] = ("SK_ID_CURR", "TARGET")) -> list[str]:
    return [c for c in df.columns if c not in exclude]


def keep_columns(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ("SK_ID_CURR", "TARGET")) -> DataFrame:
    """Keys and the listed features; a listed name the table lacks is an error."""
    absent = [f for f in features if f not in df.columns]
    if absent:
        raise ValueError(f"columns not in the table: {absent}")
    return df.select(*[c for c in keep if c in df.columns], *features)


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Without the listed columns; names the table lacks are ignored."""
    return df.drop(*names)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def payload_nulls(df: DataFrame) -> DataFrame:
    """Request values: the text 'null' and NaN/±inf become NULL."""
    strings, floats = set(columns_of(df, "string")), set(columns_of(df, "float"))
    return df.select(*[
        F.nullif(F.col(c), F.lit("null")).alias(c) if c in strings else finite(F.col(c)).alias(c) if c in floats
        else F.col(c) for c in df.columns])
