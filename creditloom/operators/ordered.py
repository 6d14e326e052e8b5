"""Running totals, exact ranks and exact quantiles without a single-task window.

A window over one huge group runs in one task. Here the order column is first cut into buckets by
boundaries that come from a bounded sketch; each bucket is windowed on its own, and a small table of
bucket totals supplies what lies before it. The boundaries only steer the work, so results are exact
whatever the sketch says.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.hashing import key_digest
from creditloom.functions.naming import quoted
from creditloom.session import small_side

ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 16_384
_BUCKET = "_bucket"
_GROUP = "_group"


def quoted_column(name: str) -> Column:
    return F.col(quoted(name))


def _with_group(df: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The groups as one struct that is never NULL itself. Windows and joins on it share one
    partitioning, and rows with a NULL group still meet their own group."""
    return df.withColumn(_GROUP, F.struct(*groups) if groups else F.struct(F.lit(0).alias("all")))


def value_splits(df: DataFrame, columns: Sequence[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> dict[str, list[float]]:
    """Inner bucket boundaries per column: at most MAX_BUCKETS - 1 numbers, none when a count proves
    that the whole input fits one bucket."""
    rows = df.count()
    wanted = min(MAX_BUCKETS, -(-rows // rows_per_bucket))
    if wanted <= 1:
        return {c: [] for c in columns}
    probes = [i / wanted for i in range(1, wanted)]
    row = df.agg(*[F.percentile_approx(c, probes, 4 * wanted).alias(c) for c in columns]).first()
    # Boundaries rise strictly; NaN and infinity have the outer buckets.
    return {c: sorted({float(v) for v in row[c] if math.isfinite(v)}) if row[c] else [] for c in columns}


def with_buckets(df: DataFrame, splits: dict[str, list[float]], names: dict[str, str]) -> DataFrame:
    """Add one bucket number per split column."""
    todo = {c: s for c, s in splits.items() if s}
    flat = {names[c]: F.lit(0) for c, s in splits.items() if not s}
    df = df.withColumns(flat) if flat else df
    if not todo:
        return df
    edges = [[float("-inf"), *s, float("inf")] for s in todo.values()]
    typed = df.withColumns({c: F.col(c).cast("double") for c in todo})
    cut = Bucketizer(splitsArray=edges, inputCols=list(todo), outputCols=[names[c] for c in todo],
                     handleInvalid="keep").transform(typed)
    # NULL gets a bucket of its own below all others, as NULL sorts below all values.
    return cut.withColumns({names[c]: F.coalesce(F.col(names[c]).cast("int"), F.lit(-1)) for c in todo})


def running_totals(df: DataFrame, order: str, totals: Sequence[str], groups: Sequence[str] = (),
                   ascending: bool = True, rows_per_bucket: int = ROWS_PER_BUCKET,
                   splits_from: DataFrame | None = None) -> DataFrame:
    """Add `before_<t>`, `cum_<t>` and `all_<t>` for each total, along `order` inside each group.

    `df` holds one row per (groups, order); aggregate to that first. `splits_from` is a frame with
    the order column to find boundaries on, when one is cheaper to scan and has at least as many rows.
    """
    groups = list(groups)
    splits = value_splits(splits_from if splits_from is not None else df, [order], rows_per_bucket)

    def direction(c: str) -> Column:
        return F.col(c).asc() if ascending else F.col(c).desc()

    if not splits[order]:
        # Proven small: at most rows_per_bucket rows in all.
        part = Window.partitionBy(*(groups or [F.lit(0)]))
        run = part.orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
        out = df.withColumns({f"cum_{t}": F.sum(t).over(run) for t in totals})
        out = out.withColumns({f"all_{t}": F.sum(t).over(part) for t in totals})
        return out.withColumns({f"before_{t}": F.col(f"cum_{t}") - F.col(t) for t in totals})

    cut = _with_group(with_buckets(df, splits, {order: _BUCKET}), groups)
    offsets = _bucket_offsets(cut, totals, ascending)
    run = Window.partitionBy(_GROUP, _BUCKET).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({f"_in_{t}": F.sum(t).over(run) for t in totals})
    joined = _join_offsets(local, offsets)
    out = joined.withColumns({f"cum_{t}": F.col(f"_off_{t}") + F.col(f"_in_{t}") for t in totals})
    out = out.withColumns({f"before_{t}": F.col(f"cum_{t}") - F.col(t) for t in totals})
    return out.drop(_GROUP, _BUCKET, *[f"_in_{t}" for t in totals], *[f"_off_{t}" for t in totals])


def _bucket_offsets(cut: DataFrame, totals: Sequence[str], ascending: bool = True) -> DataFrame:
    """What lies before each bucket, its size, and the group total. At most MAX_BUCKETS (or 16**prefix md5
    prefixes) rows per group."""
    per = cut.groupBy(_GROUP, _BUCKET).agg(*[F.sum(t).alias(t) for t in totals])
    part = Window.partitionBy(_GROUP)
    order = F.col(_BUCKET).asc() if ascending else F.col(_BUCKET).desc()
    prior = part.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return per.select(_GROUP, _BUCKET,
                      *[F.coalesce(F.sum(t).over(prior), F.lit(0)).alias(f"_off_{t}") for t in totals],
                      *[F.sum(t).over(part).alias(f"all_{t}") for t in totals],
                      *[F.col(t).alias(f"_size_{t}") for t in totals])


def _join_offsets(left: DataFrame, offsets: DataFrame) -> DataFrame:
    return left.join(offsets.drop(*[c for c in offsets.columns if c.startswith("_size_")]), [_GROUP, _BUCKET])


def digest_rank(df: DataFrame, key: str, strata: Sequence[str], seed: int, prefix: int = 4) -> DataFrame:
    """Add `rank` (1..n) and `stratum_size`: the row's place in its stratum in md5 order of the key.

    A row without a key is placed by a digest of its other columns, and rows that share a key are told apart by it; equal rows are
    interchangeable. Every row gets a place.

    Digests are uniform, so their first `prefix` hex digits are even buckets of any stratum; a
    stratum with nearly all rows is spread over 16**prefix windows.
    """
    strata = list(strata)
    content = F.xxhash64(F.lit(seed), *[quoted_column(f.name) for f in df.schema if "map<" not in f.dataType.simpleString()])
    spread = _with_group(df, strata).withColumn("_content", content) \
        .withColumn("_digest", F.coalesce(key_digest(F.col(key), seed), F.md5(F.col("_content").cast("string")))) \
        .withColumn(_BUCKET, F.substring("_digest", 1, prefix))
    offsets = _bucket_offsets(spread.select(_GROUP, _BUCKET, F.lit(1).alias("rows")), ["rows"])
    inside = Window.partitionBy(_GROUP, _BUCKET).orderBy("_digest", key, "_content")
    ranked = _join_offsets(spread.withColumn("_in", F.row_number().over(inside)), offsets)
    return ranked.withColumn("rank", F.col("_off_rows") + F.col("_in")) \
        .withColumnRenamed("all_rows", "stratum_size").drop(_GROUP, "_digest", "_content", _BUCKET, "_in", "_off_rows")


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], groups: Sequence[str] = (),
                    rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Linear-interpolation quantiles of several columns: (groups, column, n, q<i>...).

    An input proven to fit one bucket goes through the built-in aggregate. Beyond that only the
    buckets that hold a wanted rank are sorted, and equal values travel as one row with a count, so
    neither a huge group nor a huge tie lands in one task.
    """
    groups, columns = list(groups), list(columns)
    typed = df.select(*groups, *[F.col(c).cast("double").alias(c) for c in columns])
    splits = value_splits(typed, columns, rows_per_bucket)
    if not any(splits.values()):
        return _small_quantiles(typed, columns, probs, groups)
    cut = with_buckets(typed, splits, {c: f"{_BUCKET}_{c}" for c in columns})
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value"),
                               F.col(f"{_BUCKET}_{c}").alias(_BUCKET)) for c in columns])
    long = cut.select(*groups, F.explode(cells).alias("_c")).select(*groups, "_c.*").filter(F.col("value").isNotNull())
    long = _with_group(long, [*groups, "column"]).drop(*groups, "column")
    offsets = _bucket_offsets(long.withColumn("rows", F.lit(1)), ["rows"])
    first, size, last = F.col("_off_rows"), F.col("_size_rows"), F.col("all_rows") - 1
    hit = F.lit(False)
    for p in probs:
        low, high = F.floor(last * p), F.ceil(last * p)
        hit = hit | ((low >= first) & (low < first + size)) | ((high >= first) & (high < first + size))
    # Joining before the count drops the rows of buckets that hold no wanted rank: at most two
    # buckets per quantile, group and column remain, few enough to reach the rows by broadcast.
    wanted = _join_offsets(long, small_side(offsets.filter(hit)))
    counts = wanted.groupBy(_GROUP, _BUCKET, "value").agg(
        F.count(F.lit(1)).alias("rows"), F.first("_off_rows").alias("_off_rows"), F.first("all_rows").alias("n"))
    run = Window.partitionBy(_GROUP, _BUCKET).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("_end", F.col("_off_rows") + F.sum("rows").over(run)) \
        .withColumn("_start", F.col("_end") - F.col("rows"))
    picks = []
    for i, p in enumerate(probs):
        place = (F.col("n") - 1) * F.lit(float(p))
        low, high = F.floor(place), F.ceil(place)
        at_low = F.max(F.when((low >= F.col("_start")) & (low < F.col("_end")), F.col("value")))
        at_high = F.max(F.when((high >= F.col("_start")) & (high < F.col("_end")), F.col("value")))
        share = F.max(place - low)
        picks.append((at_low + (at_high - at_low) * share).alias(f"q{i}"))
    return placed.groupBy(_GROUP).agg(F.max("n").alias("n"), *picks).select(
        f"{_GROUP}.*", "n", *[f"q{i}" for i in range(len(probs))])


def _small_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], groups: Sequence[str]) -> DataFrame:
    """At most ROWS_PER_BUCKET rows in all: one aggregate, then one row per group and column."""
    shares = F.array(*[F.lit(float(p)) for p in probs])
    wide = df.groupBy(*groups).agg(*[F.struct(F.lit(c).alias("column"), F.count(c).alias("n"), F.percentile(c, shares).alias("q")).alias(f"_{i}")
                                     for i, c in enumerate(columns)])
    rows = wide.select(*groups, F.explode(F.array(*[F.col(f"_{i}") for i in range(len(columns))])).alias("r")).filter("r.n > 0")
    return rows.select(*groups, "r.column", "r.n", *[F.col("r.q")[i].alias(f"q{i}") for i in range(len(probs))])
