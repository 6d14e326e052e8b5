"""SimHash near-duplicates with a hierarchical index in Gray order.

Fingerprints have 64 bits. Distinct ones are linked when at most two bits differ. To find the links:

* Cells. If two fingerprints differ in at most two bits, then of any three blocks of bits they agree on one.
  Each fingerprint goes to three cells, one per block; a cell too large for one task is cut again by three blocks of the
  remaining bits, and so on until few bits are left, which bounds the cell. The blocks of a cut cover all remaining bits, so no
  link is lost, and no cap is needed.
* Index. Inside a cell fingerprints are sorted by Gray rank, so that neighbours share many bits. Runs of neighbours form
  the leaves. A node knows which bits all of its members share (mask) and their values (pattern); upper nodes
  factor out what their children share. Two nodes are compared on the bits that both masks fix: the differences
  add up on the way down, and a pair of groups with more than two is dropped with everything below.
* Each cell reports every linked fingerprint with the smallest one it reaches inside the cell, never all pairs. The
  components over these links are those over all links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.llm.common import ascii_lower, packed, stored, text_hash, unpacked
from creditloom.llm.components import components

BITS, LIMIT = 64, 2
CELL_ROWS, LEAF, FAN = 4096, 16, 8
_CHUNK = 1 << 16


def fingerprint_of(text: str, shingle: int = 3) -> int:
    """Majority bits over the XXH64 (seed 42) of word shingles, as a signed 64-bit number; 0 without words."""
    import re

    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    if len(words) <= shingle:
        grams: Iterator[str] = iter([" ".join(words)])
        n = 1
    else:
        n = len(words) - shingle + 1
        grams = map(" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), dtype=np.uint64, count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, n, _CHUNK):
        part = hashes[start:start + _CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


@F.pandas_udf(T.LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")


def fingerprints(text: Column) -> Column:
    return _fingerprints(ascii_lower(F.coalesce(text, F.lit(""))))


# --- index inside a cell ---------------------------------------------------------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    x = x.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


def _nodes(masks: np.ndarray, patterns: np.ndarray, fan: int) -> tuple[np.ndarray, np.ndarray]:
    """One level up: what `fan` neighbours share."""
    starts = np.arange(0, len(masks), fan)
    all_one = np.bitwise_and.reduceat(patterns & masks, starts)
    all_zero = np.bitwise_and.reduceat(~patterns & masks, starts)
    return all_one | all_zero, all_one


def _near(a: np.ndarray, b: np.ndarray, masks: np.ndarray, patterns: np.ndarray) -> np.ndarray:
    return np.bitwise_count((patterns[a] ^ patterns[b]) & masks[a] & masks[b]) <= LIMIT


def linked_pairs(codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j in Gray order) of `codes`, sorted by Gray rank, that differ in at most LIMIT bits, in batches."""
    levels = [(np.full(len(codes), ~np.uint64(0)), codes)]
    fans = []
    while len(levels[-1][0]) > 1:
        fans.append(LEAF if len(levels) == 1 else FAN)
        levels.append(_nodes(*levels[-1], fans[-1]))
    stack = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b = stack.pop()
        if level == 0:
            yield a, b
            continue
        fan, (masks, patterns) = fans[level - 1], levels[level - 1]
        step = max(1, (1 << 20) // fan**2)
        if len(a) > step:
            stack += [(level, a[i:i + step], b[i:i + step]) for i in range(0, len(a), step)]
            continue
        grid = np.arange(fan)
        x = np.repeat(a * fan, fan * fan) + np.tile(np.repeat(grid, fan), len(a))
        y = np.repeat(b * fan, fan * fan) + np.tile(grid, fan * len(a))
        kept = (x < len(masks)) & (y < len(masks)) & ((x < y) if level == 1 else (x <= y))
        x, y = x[kept], y[kept]
        kept = _near(x, y, masks, patterns)
        stack.append((level - 1, x[kept], y[kept]))


def cell_stars(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For distinct codes of one cell: (code, smallest linked code reachable) for every code that has a link to a smaller one."""
    codes = codes[np.argsort(gray_rank(codes))]
    lowest = np.arange(len(codes))
    signed = codes.view(np.int64)

    def root(i: int) -> int:
        while lowest[i] != i:
            lowest[i] = lowest[lowest[i]]
            i = lowest[i]
        return i

    for a, b in linked_pairs(codes):
        for i, j in zip(a.tolist(), b.tolist(), strict=True):
            i, j = root(i), root(j)
            if i != j:
                i, j = (i, j) if signed[i] < signed[j] else (j, i)
                lowest[j] = i
    roots = np.array([root(i) for i in range(len(codes))], dtype=np.int64)
    moved = np.flatnonzero(roots != np.arange(len(codes)))
    return signed[moved], signed[roots[moved]]


def _runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by cell; a cell that goes over the end of a batch is carried on. Memory: one batch and one cell."""
    def stars(cells: np.ndarray, codes: np.ndarray) -> pd.DataFrame:
        edges = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1], True])
        found = [cell_stars(np.unique(codes[a:b]).astype(np.int64).view(np.uint64)) for a, b in zip(edges[:-1], edges[1:], strict=True) if b - a > 1]
        if not found:
            return pd.DataFrame({"u": np.zeros(0, np.int64), "v": np.zeros(0, np.int64)})
        return pd.DataFrame({"u": np.concatenate([f[0] for f in found]), "v": np.concatenate([f[1] for f in found])})

    held: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in batches:
        if not len(batch):
            continue
        cells, codes = batch["cell"].to_numpy(), batch["code"].to_numpy()
        held.append((cells, codes))
        if cells[0] == cells[-1] and held[0][0][0] == cells[0]:
            continue
        cells, codes = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        cut = np.flatnonzero(cells != cells[-1])[-1] + 1 if cells[0] != cells[-1] else 0
        if cut:
            yield stars(cells[:cut], codes[:cut])
        held = [(cells[cut:], codes[cut:])]
    if held:
        yield stars(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))


# --- cells -----------------------------------------------------------------------------------------------------------

def _three_blocks(bits: list[int]) -> list[list[int]]:
    third = [len(bits) * k // 3 for k in range(4)]
    return [bits[third[k]:third[k + 1]] for k in range(3)]


def _mask(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << 64) if value >> 63 else value


def links(codes: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """`codes` (code: distinct long) to (u, v): every code with a smaller one it is linked to inside a cell."""
    spark = codes.sparkSession
    out = spark.createDataFrame([], "u bigint, v bigint")
    # A branch of the cut: which bits are still free, and which bits name the cell.
    todo: list[tuple[DataFrame, list[int], list[int]]] = [(codes, list(range(BITS)), [])]
    while todo:
        cut = None
        tables: dict[int, tuple[list[int], list[int]]] = {}
        for rows, free, fixed in todo:
            for block in _three_blocks(free):
                name = len(tables)
                rest, named = [b for b in free if b not in block], fixed + block
                tables[name] = (rest, named)
                part = rows.select("code", F.lit(name).alias("branch"), F.col("code").bitwiseAND(F.lit(_mask(named))).alias("value"))
                cut = part if cut is None else cut.union(part)
        cut = cut.withColumn("cell", F.xxhash64("branch", "value"))
        sizes = cut.groupBy("cell", "branch", "value").agg(F.count("*").alias("n")).where("n > 1")
        sized = stored(cut.join(sizes.select("branch", "value", "n"), ["branch", "value"]), "simhash-cells")
        final = [name for name, (rest, _) in tables.items() if len(rest) <= LIMIT * 6]
        large = (F.col("n") > cell_rows) & ~F.col("branch").isin(final)
        small = sized.where(~large).select("cell", "code").repartition("cell").sortWithinPartitions("cell")
        out = out.union(small.mapInPandas(_runs, "u bigint, v bigint"))
        todo = [(sized.where(large & (F.col("branch") == r["branch"])).select("code", "cell"), *tables[r["branch"]])
                for r in sized.where(large).select("branch").distinct().collect()]
    return out


def _key(doc_id: Column, text: Column) -> Column:
    return F.concat_ws("|", F.coalesce(doc_id.cast("string"), F.lit("")), text_hash(text).cast("string"))


def classes(docs: DataFrame) -> DataFrame:
    """(key, doc_id, fingerprint, component_id) per input row, without the texts; `key` names doc_id and text."""
    doc_id, text = F.col("doc_id"), F.col("text")
    prints = stored(docs.select(_key(doc_id, text).alias("key"), "doc_id", fingerprints(text).alias("code")), "simhash-prints")
    codes = stored(prints.groupBy("code").agg(F.min("doc_id").alias("least")), "simhash-codes")
    joined = components(links(codes.select("code")))
    named = codes.join(joined, codes["code"] == joined["node"], "left").select("code", "least", F.coalesce("root", "code").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least, "root").select("code", "component_id")
    return prints.join(named, "code").select("key", "doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """`docs` with `fingerprint` (16 hexadecimal digits) and `component_id` (the smallest doc_id that links reach, its own included).

    One row per input row. Null and empty texts have fingerprint zero and are linked like others; equal rows are in one
    component. A null doc_id is never the smallest; a component of such rows only has a null id. Input columns with
    the names of added ones are replaced. An empty table gives an empty result.
    """
    found = classes(docs).select("key", "fingerprint", "component_id").distinct()
    rows = packed(docs).withColumn("key", _key(F.col("row.doc_id"), F.col("row.text")))
    return unpacked(rows.join(found, "key"), docs.columns, fingerprint=F.col("fingerprint"), component_id=F.col("component_id"))


def one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay: of every group of near copies the row with the smallest doc_id, once.

    Rows without a doc_id come last; among rows of one doc_id the smallest text digest stays. All rows without any doc_id in their
    component are one group per fingerprint.
    """
    found = stored(classes(docs), "simhash-classes")
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("f"), "fingerprint"))
    winners = found.groupBy(group.alias("group")).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("w")).select(F.col("w.key").alias("key"))
    rows = packed(docs).withColumn("key", _key(F.col("row.doc_id"), F.col("row.text"))).join(winners, "key", "left_semi")
    facts = found.agg(F.count("*").alias("n"), F.countDistinct("key").alias("d")).first()
    if facts["n"] != facts["d"]:
        rows = rows.groupBy("key").agg(F.first("row").alias("row"))
    return unpacked(rows, docs.columns)
