"""Category dictionaries, one-hot and label encoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.columns import indicator
from creditloom.operators.rollup import columns_of, dummy_name

MAX_CATEGORIES = 2000


def category_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct (column, value) pairs of several columns in one pass; NULL values are kept."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(F.explode(pairs).alias("p")).select("p.column", "p.value").distinct()


def category_dictionaries(frames: Mapping[str, DataFrame], nulls: bool = True,
                          max_categories: int = MAX_CATEGORIES) -> dict[str, dict[str, list[str | None]]]:
    """Category dictionary of each named table: sorted values per text column, the missing one last.

    All tables go through one job. The result names output columns, so it must be small: more than
    `max_categories` per table is an error, and never more than the limit reaches the driver.
    """
    texts = {name: columns_of(df, "string") for name, df in frames.items()}
    parts = [category_rows(df, texts[n]).limit(max_categories + 1).withColumn("table", F.lit(n))
             for n, df in frames.items() if texts[n]]
    rows = reduce(lambda a, b: a.unionByName(b), parts).collect() if parts else []
    out: dict[str, dict[str, list[str | None]]] = {}
    for name, columns in texts.items():
        own = [r for r in rows if r["table"] == name]
        if len(own) > max_categories:
            raise ValueError(f"more than {max_categories} categories in {columns}; encode fewer columns")
        out[name] = {c: sorted(r["value"] for r in own if r["column"] == c and r["value"] is not None) + ([None] if nulls else [])
                     for c in columns}
    return out


def category_dictionary(df: DataFrame, columns: Sequence[str] | None = None, nulls: bool = True,
                        max_categories: int = MAX_CATEGORIES) -> dict[str, list[str | None]]:
    """The dictionary of one table, of all its text columns or of chosen columns."""
    if columns is not None:
        df = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return category_dictionaries({"": df}, nulls, max_categories)[""]


def one_hot(df: DataFrame, dictionary: Mapping[str, Sequence[str | None]],
            drop_first: bool = False) -> tuple[DataFrame, list[str], list[str]]:
    """Replace each dictionary column by 0/1 columns.

    Returns the frame, the new names and the names dropped by `drop_first`. The dictionary fixes the
    output width, so training and new data give the same columns.
    """
    new, dropped, added = [], [], []
    for c, values in dictionary.items():
        kept = list(values)
        if drop_first:
            first = [v for v in kept if v is not None][:1]
            dropped += [dummy_name(c, v) for v in first]
            kept = [v for v in kept if v not in first]
        for v in kept:
            name = dummy_name(c, v)
            added.append(name)
            new.append(indicator(F.col(c), v).alias(name))
    rest = [c for c in df.columns if c not in dictionary]
    return df.select(*rest, *new), added, dropped


def label_encode(df: DataFrame, dictionary: Mapping[str, Sequence[str | None]]) -> DataFrame:
    """Codes 0..n-1 in alphabetical order, NULL and unseen values -1."""
    def code(c: str, values: Sequence[str | None]):
        known = [v for v in values if v is not None]
        lookup = F.create_map(*[F.lit(x) for i, v in enumerate(known) for x in (v, i)])
        return F.coalesce(F.try_element_at(lookup, F.col(c)), F.lit(-1)).alias(c) if known else F.lit(-1).alias(c)

    return df.select(*[code(c, dictionary[c]) if c in dictionary else F.col(c) for c in df.columns])
