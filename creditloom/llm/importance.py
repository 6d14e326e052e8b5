"""Resampling towards a target by importance: hashed features, bucket histograms, gains, and a seeded draw without replacement.

An untrained pre-tokeniser, a regular-expression split over ASCII-lowered text, returns words with offsets. A feature is a run of one to
`longest` consecutive words: a window from the start of its first word to the end of its last one, cut out of the words joined by single
spaces. Its bucket is the CRC-32 of its bytes modulo `buckets`, and a document is the sparse histogram of its buckets. The
histograms of the whole corpus and of the target give every bucket a gain, the scaled log ratio of its smoothed shares. A
document's weight is the sum of the gains of its features; Gumbel noise drawn from its id turns the highest scores into a draw
without replacement in proportion to exp(weight / 1000).

Texts are split once: the sparse histograms are written to the shared folder, and totals and weights come from there. Only the bucket
totals, `buckets` numbers for corpus and target each, reach the driver.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.llm.common import ranked, stored, unpacked

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PIECE = 1 << 16
_CACHE = 1 << 18
_NOT_WORD = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def splitter():
    """The pre-tokeniser: what lies between words is removed."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORDS), "removed", invert=True)


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """The text in pieces of about `size` characters that end outside words, so that a long text is never held as a list of all its words."""
    start = 0
    while len(text) - start > size:
        gap = _NOT_WORD.search(text, start + size)
        if gap is None:
            break
        yield text[start:gap.end()]
        start = gap.end()
    yield text[start:]


class Buckets:
    """Bucket numbers of features; those of a bounded number of features are remembered."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.known = buckets, {}

    def of(self, feature: str) -> int:
        found = self.known.get(feature)
        if found is None:
            if len(self.known) >= _CACHE:
                self.known.clear()
            found = self.known[feature] = zlib.crc32(feature.encode()) % self.buckets
        return found


def histogram(text: str, split, table: Buckets, longest: int) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Words, features, and the buckets of the features with their counts."""
    lowered = text.encode().lower().decode()
    n_words, n_features, found = 0, 0, Counter()
    tail: list[str] = []  # the last words of the pieces before, which windows of several words reach back to
    for piece in pieces(lowered):
        spans = split.pre_tokenize_str(piece)
        n_words += len(spans)
        if longest == 1:
            n_features += len(spans)
            found.update(word for word, _ in spans)
            continue
        words = tail + [word for word, _ in spans]
        ends = np.cumsum([len(w) + 1 for w in words]) - 1 if words else np.zeros(0, int)
        joined, starts = " ".join(words), [0, *(ends[:-1] + 1).tolist()]
        for k in range(1, longest + 1):
            # Windows that end inside the tail were counted with the piece before.
            windows = list(zip(starts, ends[k - 1:].tolist(), strict=False))[max(0, len(tail) - k + 1):]
            n_features += len(windows)
            found.update(joined[a:z] for a, z in windows)
        tail = words[-(longest - 1):]
    counts: dict[int, int] = {}
    for feature, n in found.items():
        bucket = table.of(feature)
        counts[bucket] = counts.get(bucket, 0) + n
    slots = np.fromiter(sorted(counts), np.int32, len(counts))
    return n_words, n_features, slots, np.fromiter((counts[s] for s in slots.tolist()), np.int32, len(counts))


def histograms(docs: DataFrame, text: str = "text", longest: int = 1, buckets: int = 10_000) -> DataFrame:
    """`docs` without `text`, and `n_words`, `n_features`, `slots` (buckets, ascending) and `counts`. A null text has no words."""
    added = {"n_words": "bigint", "n_features": "bigint", "slots": "array<int>", "counts": "array<int>"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, table = splitter(), Buckets(buckets)
        for batch in batches:
            rows = [histogram(t, split, table, longest) if t is not None else (0, 0, np.zeros(0, np.int32), np.zeros(0, np.int32)) for t in batch.pop(text)]
            for i, name in enumerate(added):
                batch[name] = [r[i] for r in rows]
            yield batch

    kept = [f for f in docs.schema if f.name != text]
    return docs.mapInPandas(run, ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in kept], *[f"{n} {t}" for n, t in added.items()]]))


def bucket_totals(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over all rows; at most `buckets` numbers."""
    found = rows.select(F.explode(F.arrays_zip("slots", "counts")).alias("e")).groupBy("e.slots").agg(F.sum("e.counts").alias("n")).collect()
    totals = np.zeros(buckets, np.int64)
    for r in found:
        totals[r["slots"]] = r["n"]
    return totals


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: 1000 times the log ratio of its smoothed share in the target to that in the corpus, rounded down."""
    s_all, t_all, buckets = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + buckets) / ((s + 1.0) * (t_all + buckets))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(key: Column) -> Column:
    """Gumbel noise times 1000, rounded down, from the first 32 bits of the key's SHA-256."""
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h.cast("double") + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, seed: int = 2024, min_words: int = 20, percent: int = 10,
             carried: list[str] | None = None) -> DataFrame:
    """`docs` with `n_words`, `n_features`, `weight`, `score` and `rank`: 1, 2, 3... for the drawn documents, null for the others.

    Of the N documents with at least `min_words` words, the floor(percent * N / 100) with the highest scores are drawn; ties go to the
    smaller doc_id (null last). `docs` needs doc_id and text, `target` text; `carried` names the columns to keep (default:
    all), and input columns with the names of added ones are replaced. Null and empty texts have no features, weight 0 and no rank; a
    null doc_id draws its noise as the empty string. Repeated rows count each time and have equal scores and ranks of their own.
    An empty table gives an empty result, an empty target makes all gains alike but for the corpus counts.
    """
    columns = docs.columns if carried is None else carried
    base = docs.select(F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, "doc_id"])]).alias("row"), "text")
    rows = stored(histograms(base, "text", longest, buckets), "importance-histograms")
    gain = gains(bucket_totals(rows, buckets), bucket_totals(histograms(target.select("text"), "text", longest, buckets), buckets))

    @F.pandas_udf("bigint")
    def weighed(slots: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series([int(gain[s] @ c) for s, c in zip(slots, counts, strict=True)], dtype="int64")

    scored = rows.select("row", "n_words", "n_features", weighed("slots", "counts").alias("weight"))
    scored = scored.withColumn("score", F.col("weight") + gumbel(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")))))
    fit = F.col("n_words") >= min_words
    drawn = percent * rows.where(fit).count() // 100
    placed = ranked(scored.where(fit), "place", F.desc("score"), F.asc_nulls_last("row.doc_id"))
    result = (placed.withColumn("place", F.when(F.col("place") <= drawn, F.col("place")))
              .unionByName(scored.where(~fit).withColumn("place", F.lit(None).cast("bigint"))))
    return unpacked(result, columns, n_words=F.col("n_words"), n_features=F.col("n_features"), weight=F.col("weight"), score=F.col("score"), rank=F.col("place"))
