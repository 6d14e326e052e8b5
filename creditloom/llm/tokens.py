"""Token totals by source, language and tokenizer version, kept up to date by deltas.

The state is a folder of committed batches. A batch holds signed changes, already added up per (source, lang,
version): an insert adds a document and its tokens, a delete takes both away, a revised count changes the tokens
by the difference. The totals are the sum over batches, so the order of batches doesn't matter. A batch is
committed when Spark's success marker is there; committing its id again changes nothing, and a batch that was broken
off is written anew. A snapshot folds committed batches into one and remembers their ids.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["source", "lang", "version"]
# Fixed value: the split pattern of the byte-level vocabulary, as its publisher states it.
GPT_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Fixed value: the characters that Unicode calls white space.
BLANKS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_LONG_BLANKS = re.compile(f"[{BLANKS}]{{1000,}}")
DELTA_SCHEMA = "source string, lang string, version string, n_docs bigint, n_tokens bigint"


def word_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")), F.lit(0)).cast("bigint")


def bpe_tokens(docs: DataFrame, ranks_path: str, added: str = "n_bpe", pattern: str = GPT_PATTERN, carried: list[str] | None = None) -> DataFrame:
    """(doc_id, source, lang, n_words, `carried` columns, `added`) with counts by a byte-pair vocabulary file (base64 token and rank per line).

    Null texts have no tokens. Every document is counted whole, long runs of blanks included (see `count_tokens`); the file is read once per
    Python worker.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding, one_piece = byte_pair_encoding(ranks_path, pattern), byte_pair_encoding(ranks_path, "(?s:.+)")
        for batch in batches:
            texts = batch.pop("text")
            batch[added] = [0 if t is None else count_tokens(t, encoding, one_piece) for t in texts]
            yield batch

    narrow = docs.select("doc_id", "source", "lang", word_tokens(F.col("text")).alias("n_words"), *(carried or []), "text")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema if f.name != "text"]
    return narrow.mapInPandas(count, ", ".join([*fields, f"`{added}` bigint"]))


def byte_pair_encoding(ranks_path: str, pattern: str = GPT_PATTERN):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding(Path(ranks_path).stem, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str, encoding, one_piece) -> int:
    """Tokens of a text by `encoding`, whose split pattern treats blanks as GPT_PATTERN does; `one_piece` encodes without splitting.

    On a run of blanks the pattern goes back character by character, too deep for a run of a million. What it finds there is known: all
    blanks but the last one are a piece, the last one begins the next piece; at the end of the text all of them are a piece.
    """
    n = start = 0
    for run in _LONG_BLANKS.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        n += len(encoding.encode_ordinary(text[start:run.start()])) + len(one_piece.encode_ordinary(text[run.start():stop]))
        start = stop
    return n + len(encoding.encode_ordinary(text[start:]))


def inserts(rows: DataFrame, version: str, tokens: str) -> DataFrame:
    return rows.select("source", "lang", F.lit(version).alias("version"), F.lit(1).alias("sign"), F.col(tokens).alias("delta"))


def deletes(rows: DataFrame, version: str, tokens: str) -> DataFrame:
    return rows.select("source", "lang", F.lit(version).alias("version"), F.lit(-1).alias("sign"), (-F.col(tokens)).alias("delta"))


def revisions(rows: DataFrame, version: str, old: str, new: str) -> DataFrame:
    return rows.select("source", "lang", F.lit(version).alias("version"), F.lit(0).alias("sign"), (F.col(new) - F.col(old)).alias("delta"))


class Rollup:
    """Totals kept in `root`, a folder that every executor reaches.

    Nulls in source or lang are groups of their own; a null count counts as 0. Repeated rows count each time: a feed
    states what it means. A batch id has one writer at a time. A group whose documents and tokens are all taken away is not listed.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def committed(self, batch: str) -> bool:
        return self._files().exists(self._path(f"batch={batch}/_SUCCESS"))

    def batches(self) -> list[str]:
        files = self._files()
        if not files.exists(self._path("")) and not files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(self.root)):
            return []
        names = [s.getPath().getName() for s in files.listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(self.root))]
        return sorted(n[6:] for n in names if n.startswith("batch=") and self.committed(n[6:]))

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Adds a batch; false, and no change, if its id is already in the totals."""
        if not batch or "/" in batch or "=" in batch:
            raise ValueError("a batch id is a plain file name")
        if self.committed(batch) or self._is_folded(batch):
            return False
        deltas = changes.groupBy(*KEYS).agg(F.sum("sign").cast("bigint").alias("n_docs"), F.coalesce(F.sum("delta"), F.lit(0)).cast("bigint").alias("n_tokens"))
        deltas.write.mode("overwrite").parquet(f"{self.root}/batch={batch}")
        return True

    def _snapshots(self) -> list[str]:
        return [b for b in self.batches() if b.startswith("snapshot-")]

    def _folded(self, snapshots: list[str]) -> DataFrame:
        """Ids of the batches that the snapshots hold: (batch, snapshot)."""
        if not snapshots:
            return self.spark.createDataFrame([], "batch string, snapshot string")
        parts = [self.spark.read.schema("batch string").parquet(f"{self.root}/folded/{s}").withColumn("snapshot", F.lit(s)) for s in snapshots]
        return reduce(DataFrame.union, parts)

    def _is_folded(self, batch: str) -> bool:
        return not self._folded(self._snapshots()).where(F.col("batch") == batch).isEmpty()

    def compact(self, name: str) -> None:
        """Folds all batches into the snapshot `name`; their ids stay known, so a late retry still changes nothing."""
        names = [b for b in self.batches() if b != f"snapshot-{name}"]
        if not names or self.committed(f"snapshot-{name}"):
            return
        fresh = self.spark.createDataFrame([(n,) for n in names if not n.startswith("snapshot-")], "batch string")
        ids = fresh.union(self._folded(self._snapshots()).select("batch")).distinct()
        ids.write.mode("overwrite").parquet(f"{self.root}/folded/snapshot-{name}")
        self.totals().write.mode("overwrite").parquet(f"{self.root}/batch=snapshot-{name}")

    def _live(self) -> list[str]:
        """The largest snapshot and the batches that it doesn't hold; ids that it holds never come to the driver."""
        names, snapshots = self.batches(), self._snapshots()
        if not snapshots:
            return names
        sizes = {r["snapshot"]: r["n"] for r in self._folded(snapshots).groupBy("snapshot").agg(F.count("*").alias("n")).collect()}
        last = max(snapshots, key=lambda s: (sizes.get(s, 0), s))
        present = self.spark.createDataFrame([(n,) for n in names if n not in snapshots], "batch string")
        left = present.join(self._folded([last]), "batch", "left_anti").collect()
        return [last, *sorted(r["batch"] for r in left)]

    def totals(self) -> DataFrame:
        """source, lang, version, n_docs, n_tokens over all committed batches."""
        paths = [f"{self.root}/batch={b}" for b in self._live()]
        rows = self.spark.read.schema(DELTA_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], DELTA_SCHEMA)
        return rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")
