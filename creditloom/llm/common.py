"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creditloom.session import scratch_path, small_side

A_TO_Z, A_TO_Z_SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    return F.translate(text, A_TO_Z, A_TO_Z_SMALL)


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def hashable(df: DataFrame) -> list[str]:
    """The columns that a hash can take; maps and variants cannot be hashed."""
    return [f.name for f in df.schema if "map<" not in (kind := f.dataType.simpleString()) and "variant" not in kind]


def packed(df: DataFrame) -> DataFrame:
    """All columns inside one struct `row`, so that no helper column can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, columns: list[str], **added: Column) -> DataFrame:
    """The packed columns and `added`; an added column replaces an input column of its name."""
    taken = {name.lower() for name in added}
    kept = [F.col("row").getField(c).alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *[value.alias(name) for name, value in added.items()])


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: computed once, and safe when executors are lost."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def digits16(rows: int, each: int) -> int:
    """Hexadecimal digits of a hash that cut `rows` into buckets of about `each`."""
    digits = 0
    while rows > each * 16**digits:
        digits += 1
    return digits


def broadcast_if(df: DataFrame, max_rows: int) -> DataFrame:
    """`df` marked for broadcast if a count proves that it has at most `max_rows` rows, else unchanged."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def ranked(rows: DataFrame, name: str, *order: Column) -> DataFrame:
    """`rows` with `name`: 1, 2, 3... in `order`. No task sees more than a range of the order.

    The rows are sorted by ranges and written once with their place; a row's rank is its place in its range plus the sizes of the
    ranges before, of which there are as many as shuffle partitions. Rows that are equal in `order` come in any order, split between ranges.
    """
    place = F.monotonically_increasing_id()
    sorted_rows = stored(rows.withColumn("_tie", place).orderBy(*order, "_tie").drop("_tie").withColumn("_at", place), "ranked")
    sizes = sorted_rows.groupBy(F.shiftright("_at", 33).alias("_range")).agg(F.count("*").alias("_n")).collect()
    before, starts = 0, []
    for r in sorted(sizes, key=lambda r: r["_range"]):
        starts.append((r["_range"], before))
        before += r["_n"]
    spark = rows.sparkSession
    return (sorted_rows.withColumn("_range", F.shiftright("_at", 33)).join(F.broadcast(spark.createDataFrame(starts, "_range bigint, _before bigint")), "_range")
            .withColumn(name, F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).drop("_range", "_at", "_before"))


def named_rows(df: DataFrame, name: str) -> DataFrame:
    """`df` with `at`, a number for each row, written once: the numbers stay the same when tasks are repeated."""
    return stored(df.withColumn("at", F.monotonically_increasing_id()), name)


def told_apart(rows: DataFrame, seed: int) -> DataFrame:
    """`rows` (at, and a, b: two hashes of a row's content) with a and b hashed anew; rows of equal content become different.

    A row that stands alone is decided by its content, whatever its place. Copies add their number, so that they are dealt apart like any rows.
    """
    copies = small_side(rows.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b", F.lit(True).alias("copied")))
    salt = F.when(F.col("copied"), F.col("at")).otherwise(-1)
    return rows.join(copies, ["a", "b"], "left").withColumn("salt", salt).withColumn("a2", F.xxhash64(F.lit(seed), "a", "salt")).withColumn(
        "b", F.xxhash64("b", "salt", F.lit(seed))).drop("a", "salt", "copied").withColumnRenamed("a2", "a")


def sums_before(buckets: DataFrame, keys: list[str], bucket: str, value: str, digits: int) -> DataFrame:
    """`buckets` with `before`: the sum of `value` over the smaller buckets (strings of `digits` digits) with the same keys.

    In two steps, over beginnings of half the digits and inside each of them, so that no window holds more than 16^(digits/2) rows of a key.
    """
    half = F.substring(F.col(bucket), 1, digits // 2)
    parts = buckets.withColumn("beginning", half)
    upper = parts.groupBy(*keys, "beginning").agg(F.sum(value).alias("part_sum"))
    upper = upper.withColumn("part_before", F.sum("part_sum").over(Window.partitionBy(*keys).orderBy("beginning")) - F.col("part_sum"))
    inside = F.sum(value).over(Window.partitionBy(*keys, "beginning").orderBy(bucket)) - F.col(value)
    return parts.withColumn("inside", inside).join(upper, [*keys, "beginning"]).withColumn("before", F.col("part_before") + F.col("inside")).drop(
        "beginning", "part_sum", "part_before", "inside")
