"""Document fingerprints by winnowing.

Every run of `k` characters gets a rolling hash. In every window of `w` hashes the smallest one is chosen, the rightmost of equal
ones. Two texts that share a passage of at least w + k - 1 characters share the hash chosen in it, and the
positions kept with the hashes say where. A fingerprint is the list of (hash, distance to the previous position), packed.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import stored, text_hash
from creditloom.session import small_side

K, W = 16, 32
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_ENTRY = np.dtype([("hash", "<u4"), ("step", "u1")])


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^0.. and its inverses modulo 2^64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.r_[np.uint64(1), np.full(max(n - 1, 0), b)], dtype=np.uint64)[:n] for b in (BASE, inverse))


class _Powers:
    """Powers for texts of up to the longest length seen, made once per worker."""

    def __init__(self) -> None:
        self.n, self.up, self.down = 0, *_powers(0)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            self.n = 1 << max(12, (n - 1).bit_length())
            self.up, self.down = _powers(self.n)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def rolling_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k codes: a polynomial modulo 2^64 from prefix sums, then mixed so that all bits matter."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _POWERS.upto(len(codes))
    with np.errstate(over="ignore"):
        sums = np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * down, dtype=np.uint64)
        h = sums[k - 1:].copy()
        h[1:] -= sums[:n - 1]
        h *= up[:n]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xFF51AFD7ED558CCD)
        h ^= h >> np.uint64(32)
    return h


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """Positions of the minimum of each window of w values, rightmost of equals, each position once."""
    w = min(w, len(h))
    if not w:
        return np.zeros(0, np.int64)
    low, at, span = h, np.arange(len(h), dtype=np.int32), 1
    while span < w:
        # Two spans that overlap or touch make a longer one; on equality the right one wins.
        step = min(span, w - span)
        left, right = low[:len(low) - step], low[step:]
        better = right <= left
        low, at, span = np.where(better, right, left), np.where(better, at[step:], at[:len(at) - step]), span + step
    kept = np.r_[True, at[1:] != at[:-1]]
    return at[kept]


def winnow(text: str, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray]:
    """Chosen 32-bit hashes and their positions. A text shorter than k is one run; an empty one has none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    h = rolling_hashes(codes, min(k, len(codes))) if len(codes) else np.zeros(0, np.uint64)
    at = window_minima(h, w)
    return (h[at] >> np.uint64(32)).astype(np.uint32), at


def pack(hashes: np.ndarray, at: np.ndarray) -> str:
    if not len(at):
        return ""
    entries = np.zeros(len(at), _ENTRY)
    entries["hash"], entries["step"] = hashes, np.diff(at, prepend=0)
    return base64.b64encode(entries.tobytes()).decode()


def unpack(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    entries = np.frombuffer(base64.b64decode(fingerprint), _ENTRY)
    return entries["hash"], np.cumsum(entries["step"], dtype=np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of the sets of chosen hashes; two empty ones are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = np.concatenate([a, b])
    both.sort()
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return shared / (len(both) - shared)


def fingerprint(docs: DataFrame, text: str = "text", k: int = K, w: int = W) -> DataFrame:
    """`docs` with `fingerprint` and `positions` (array<int>), one row per input row; a null text counts as empty."""
    if w > 255:
        raise ValueError("windows are at most 255 hashes, so that a step fits a byte")

    @F.pandas_udf("fingerprint string, positions array<int>")
    def made(texts: pd.Series) -> pd.DataFrame:
        found = [winnow(t or "", k, w) for t in texts]
        return pd.DataFrame({"fingerprint": [pack(*f) for f in found], "positions": [f[1].astype(np.int32) for f in found]})

    kept = [c for c in docs.columns if c.lower() not in ("fingerprint", "positions")]
    return docs.select(*kept, made(F.col(text)).alias("_made_")).select(*kept, "_made_.fingerprint", "_made_.positions")


def shared_passages(a: str, b: str) -> list[tuple[int, int]]:
    """Positions (in a, in b) of the hashes that two fingerprints share, first occurrence in b."""
    (ha, pa), (hb, pb) = unpack(a), unpack(b)
    first = dict(zip(hb[::-1].tolist(), pb[::-1].tolist(), strict=True))
    return [(p, first[h]) for h, p in zip(ha.tolist(), pa.tolist(), strict=True) if h in first]


# --- the next document in the order of ids -------------------------------------------------------------------------

def _bucket(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most `value`, found in two steps of about the square root of their number."""
    if not bounds:
        return F.lit(0)
    width = max(1, math.isqrt(len(bounds)))
    groups = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    coarse = F.size(F.filter(heads, lambda b: b <= value))
    inside = F.element_at(F.array(*[F.array(*map(F.lit, g)) for g in groups]), F.greatest(coarse, F.lit(1)))
    return F.greatest(coarse - 1, F.lit(0)) * width + F.size(F.filter(inside, lambda b: b <= value))


def with_next(docs: DataFrame, rows_per_bucket: int = 2_000, max_bounds: int = 65_536) -> DataFrame:
    """(doc_id, text, next_text) in the order of doc_id, then text digest; after the last row comes the first one.

    The ids are cut at quantiles into buckets; inside a bucket a window finds the next row, and the first row of each
    bucket is added to the bucket before it. Texts move once. Null ids come first and are spread by digest.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", text_hash(F.col("text")))
    n = rows.count()
    cuts = min(max_bounds, n // rows_per_bucket)
    bounds = rows.agg(F.percentile_approx("doc_id", [k / (cuts + 1) for k in range(1, cuts + 1)], 100 * (cuts + 1))).first()[0] if cuts else []
    bounds = sorted(set(bounds or []))
    rows = rows.withColumn("b", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(_bucket(F.col("doc_id"), bounds))).withColumn(
        "sub", F.when(F.col("doc_id").isNull(), F.shiftright("digest", 52)).otherwise(F.lit(0)))
    firsts = stored(rows.groupBy("b", "sub").agg(F.min(F.struct("doc_id", "digest")).alias("f")), "bucket-firsts")
    ordered = firsts.collect()  # at most max_bounds + 4097 rows
    ordered.sort(key=lambda r: (r["b"], r["sub"]))
    ghosts = [(r["f"]["doc_id"], r["f"]["digest"], p["b"], int(p["sub"])) for p, r in zip(ordered, ordered[1:] + ordered[:1], strict=True)]
    ghosts = docs.sparkSession.createDataFrame(ghosts, "gid bigint, gdigest bigint, gb int, gsub bigint")
    first = rows.join(small_side(ghosts, max_bounds + 5000), rows["doc_id"].eqNullSafe(F.col("gid")) & (rows["digest"] == F.col("gdigest"))).select(
        "doc_id", "text", "digest", F.col("gb").alias("b"), F.col("gsub").alias("sub"), F.lit(True).alias("ghost"))
    both = rows.select("doc_id", "text", "digest", "b", "sub", F.lit(False).alias("ghost")).unionByName(first)
    order = Window.partitionBy("b", "sub").orderBy("ghost", "doc_id", "digest")
    return both.select("doc_id", "text", "ghost", F.lead("text").over(order).alias("next_text")).where("not ghost").select("doc_id", "text", "next_text")


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by the first as many of the following text."""
    n = len(text) // 4
    return text[:len(text) - n] + following[:n]


def compare_with_edits(docs: DataFrame, k: int = K, w: int = W) -> DataFrame:
    """Per document: its fingerprint, that of its edited text, and how alike it is to the edited and to the next text."""
    import hashlib

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, text, following in zip(batch["doc_id"], batch["text"], batch["next_text"], strict=True):
                changed = edited(text, following)
                own, other, after = winnow(text, k, w), winnow(changed, k, w), winnow(following, k, w)
                out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), pack(*own), pack(*other),
                            likeness(own[0], other[0]), likeness(own[0], after[0])))
            yield pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return with_next(docs).mapInPandas(compare, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                               "near_edited double, near_next double")
