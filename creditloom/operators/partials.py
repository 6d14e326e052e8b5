"""Roll-ups as stored, mergeable states.

A state holds, per key, what a `Rollup` needs in a form that adds up: counts, sums, centred second moments, extremes, category counts
and sets of distinct values. States of new months are built from those months alone and merged with the stored ones; `finished`
turns a state into the columns that the roll-up gives over all rows. States of a batch replace an earlier write of that batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.naming import quoted
from creditloom.operators.rollup import Rollup, dummy_name, is_category

# What each function needs of a value; `rows` counts rows, also those where the value is NULL.
_NEEDS = {"min": ("lo",), "max": ("hi",), "sum": ("sum",), "mean": ("n", "sum"), "var": ("n", "sum", "m2"), "nunique": ("set",), "size": ("rows",)}
# A state from rows, and a state from states; `m2` has a form of its own.
_FROM_ROWS = {"lo": "min({v})", "hi": "max({v})", "sum": "sum({v})", "n": "count({v})", "m2": "coalesce(var_pop({v}) * count({v}), 0D)",
              "set": "array_sort(collect_set({v}))", "rows": "count_if({p})"}
_MERGED = {"lo": "min({c})", "hi": "max({c})", "sum": "sum({c})", "n": "sum({c})", "rows": "sum({c})",
           "set": "array_sort(array_distinct(flatten(collect_list({c}))))"}


def _wanted(spec: Rollup) -> Iterator[tuple[str, str, str, str, str]]:
    """(output name, function, slot, value, predicate) of every column of the roll-up."""
    def measures(prefix: str, mark: str, predicate: str):
        for column, functions in spec.measures.items():
            value = quoted(column) if predicate == "true" else f"CASE WHEN {predicate} THEN {quoted(column)} END"
            for f in functions:
                yield f"{prefix}{column}_{f.upper()}", f, f"{mark}{column}", value, predicate

    yield from measures(spec.prefix, "", "true")
    for column, values in spec.categories.items():
        for v in values:
            flag = f"CASE WHEN {is_category(column, v)} THEN 1 ELSE 0 END"
            for f in spec.category_funcs:
                yield f"{spec.prefix}{dummy_name(column, v)}_{f.upper()}", f, f"is {dummy_name(column, v)}", flag, "true"
    for prefix, predicate in spec.subsets.items():
        yield from measures(prefix, prefix, predicate)
    if spec.count_as:
        yield spec.count_as, "size", "all", "1", "true"


def _slots(spec: Rollup) -> dict[tuple[str, str], tuple[str, str]]:
    """(slot, part) -> (value, predicate); a slot serves all functions of one value."""
    return {(slot, part): (value, predicate) for _, f, slot, value, predicate in _wanted(spec) for part in _NEEDS[f]}


def _name(slot: str, part: str) -> str:
    return quoted(f"{slot}#{part}")


def states(df: DataFrame, key: str, spec: Rollup) -> DataFrame:
    """One state per key from rows. Sets grow with the distinct values of a key, all else has a fixed size."""
    return df.groupBy(key).agg(*[F.expr(f"{_FROM_ROWS[part].format(v=value, p=predicate)} AS {_name(slot, part)}")
                                 for (slot, part), (value, predicate) in _slots(spec).items()])


def _merged_moment(slot: str) -> str:
    """Second moments around the common mean, state by state; sums of squares would cancel. One entry per merged state of a key."""
    n, total, m2 = (_name(slot, part) for part in ("n", "sum", "m2"))
    entry = f"named_struct('n', double({n}), 'mean', coalesce(try_divide(double({total}), {n}), 0D), 'm2', {m2})"
    step = """named_struct('n', a.n + x.n, 'mean', a.mean + coalesce(try_divide((x.mean - a.mean) * x.n, a.n + x.n), 0D),
        'm2', a.m2 + x.m2 + coalesce(try_divide((x.mean - a.mean) * (x.mean - a.mean) * a.n * x.n, a.n + x.n), 0D))"""
    return f"aggregate(collect_list({entry}), named_struct('n', 0D, 'mean', 0D, 'm2', 0D), (a, x) -> {step}, a -> a.m2)"


def merged(parts: DataFrame, key: str, spec: Rollup) -> DataFrame:
    """One state per key from any number of states; merging in any order and grouping gives the same state."""
    return parts.groupBy(key).agg(*[
        F.expr(f"{_merged_moment(slot) if part == 'm2' else _MERGED[part].format(c=_name(slot, part))} AS {_name(slot, part)}")
        for slot, part in _slots(spec)])


def finished(state: DataFrame, key: str, spec: Rollup) -> DataFrame:
    """The columns of `rollup.rollup` from one state per key."""
    def column(name: str, f: str, slot: str, predicate: str) -> str:
        part = {p: _name(slot, p) for p in _NEEDS[f]}
        if f == "mean":
            text = f"try_divide(double({part['sum']}), {part['n']})"
        elif f == "var":
            text = f"CASE WHEN {part['n']} > 1 THEN {part['m2']} / ({part['n']} - 1) END"
        elif f == "nunique":
            text = f"bigint(size({part['set']}))"
        elif f == "size":
            text = part["rows"] if predicate == "true" else f"nullif({part['rows']}, 0)"
        else:
            text = next(iter(part.values()))
        return f"{text} AS {quoted(name)}"

    return state.selectExpr(quoted(key), *[column(name, f, slot, predicate) for name, f, slot, _, predicate in _wanted(spec)])


def write_batch(state: DataFrame, path: str, batch: str) -> None:
    """The states of one batch; writing it again replaces it, so a batch that was repeated counts once."""
    state.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def read_batches(spark: SparkSession, path: str, batches: Sequence[str] | None = None) -> DataFrame:
    """Stored states with their `batch`; of some batches only their folders are read."""
    root = path.rstrip("/")
    if batches is None:
        return spark.read.parquet(root)
    return reduce(DataFrame.unionByName, [spark.read.parquet(f"{root}/batch={b}").withColumn("batch", F.lit(b)) for b in batches])
