"""States of parts, merged, equal the roll-up of all rows."""

import math

from pyspark.sql import functions as F

from creditloom.operators import partials
from creditloom.operators.rollup import Rollup, rollup
from creditloom.session import scratch_path

SPEC = Rollup("P_", {"x": ["min", "max", "mean", "sum", "var", "nunique", "size"], "y": ["mean", "var"]}, {"kind": ["a", "b", None]},
              ("mean", "sum", "var"), {"A_": "kind = 'a'"}, "P_COUNT")


def rows(spark):
    # Far from 0: sums of squares would lose the variance beyond 1e-5. (At 1e9 a mean in doubles itself leaves but eight digits, in both ways.)
    out = [(i % 5, i % 4, None if i % 7 == 0 else 1e6 + (i * 37 % 101) / 8, float(i) if i % 5 != 3 else None, [None, "a", "b"][i % 3]) for i in range(300)]
    # Key 9 has one row, key 8 only missing values, key 7 rows in a single part.
    out += [(9, 0, 4.0, 1.0, "a"), (8, 0, None, None, None), (8, 1, None, None, "b"), (7, 2, 1.0, 2.0, "a"), (7, 2, 3.0, None, "a"), (None, 1, 2.0, 2.0, "b")]
    return spark.createDataFrame(out, "k int, part int, x double, y double, kind string")


def values(df):
    return {r["k"]: r.asDict() for r in df.collect()}


def same(a, b):
    if a is None or b is None or not isinstance(a, float):
        return a == b
    return math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def agree(left, right):
    assert left.schema.simpleString() == right.schema.simpleString()
    one, two = values(left), values(right)
    assert one.keys() == two.keys()
    wrong = [(k, c, one[k][c], two[k][c]) for k in one for c in one[k] if not same(one[k][c], two[k][c])]
    assert not wrong, wrong[:5]


def test_merged_states_equal_the_roll_up(spark):
    df = rows(spark)
    whole = rollup(df, "k", SPEC)
    parts = [partials.states(df.filter(F.col("part") == i), "k", SPEC) for i in range(4)]
    agree(partials.finished(partials.states(df, "k", SPEC), "k", SPEC), whole)
    agree(partials.finished(partials.merged(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]), "k", SPEC), "k", SPEC), whole)
    # Grouped the other way round.
    half = partials.merged(parts[3].unionByName(parts[1]), "k", SPEC)
    other = partials.merged(parts[2].unionByName(parts[0]), "k", SPEC)
    agree(partials.finished(partials.merged(half.unionByName(other), "k", SPEC), "k", SPEC), whole)


def test_a_batch_is_read_alone_and_counts_once(spark):
    df, path = rows(spark), scratch_path(spark, "states")
    for b in (0, 1, 2, 3, 3):
        partials.write_batch(partials.states(df.filter(F.col("part") == b), "k", SPEC), path, str(b))
    agree(partials.finished(partials.merged(partials.read_batches(spark, path), "k", SPEC), "k", SPEC), rollup(df, "k", SPEC))
    newest = partials.read_batches(spark, path, ["3"])
    assert newest.inputFiles() and all("batch=3/" in f for f in newest.inputFiles())


def test_no_rows(spark):
    empty = rows(spark).limit(0)
    assert partials.finished(partials.merged(partials.states(empty, "k", SPEC), "k", SPEC), "k", SPEC).isEmpty()
