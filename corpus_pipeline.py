"""A training corpus from raw documents: quality, near duplicates, benchmark passages, mixture, shards."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.llm import decontamination, mixing, quality, sharding, simhash
from creditloom.llm.common import stored, table

KEEP_SCORE = 0.3
MAX_REPETITION = 2.0
SHARDS = 16


def _through(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], *needed: str) -> DataFrame:
    """The documents that `operator` returns, as they were: it sees the columns it needs and the whole row packed in one, so that no input
    column can be taken for one that it adds."""
    slim = docs.select(F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns]).alias("document"), *[F.col(f"`{c}`") for c in needed])
    found = operator(slim)
    return found.select(*[F.col("document").getField(c).alias(c) for c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject.

    Null and empty texts count as empty and are scored like others; rows without an id and repeated rows are each judged by their text. All
    columns stay as they are, whatever their names. An empty table gives an empty result.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return _through(docs, lambda d: quality.score(d, model, "quality_score").where(F.col("quality_score") >= KEEP_SCORE), "text")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id (rows without an id come last).

    Ties: of rows that share an id the one with the smaller text digest stays, of equal rows one. Null and empty texts are one group.
    All columns stay as they are, whatever their names. An empty table gives an empty result.
    """
    return _through(docs, simhash.one_per_group, "doc_id", "text")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items.

    Null and empty texts have no words and stay; repeated rows are judged alike, rows that share an id each by their text. All
    columns stay as they are, whatever their names. An empty table gives an empty result.
    """
    items = table(spark, sf_dir, "benchmark")
    return _through(docs, lambda d: decontamination.contamination(d, items).where(~F.col("contaminated")), "doc_id", "text")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; rare sources are repeated, and no document is lost.

    A null source is a source; null and empty texts count one token; repeated rows are used each. All columns stay as they are,
    whatever their names. An empty table gives an empty result.
    """
    return _through(docs, lambda d: mixing.mix(d, max_repetition=MAX_REPETITION, carried=["document"]), "doc_id", "text", "source")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in shards of equal size, in a uniform order: the columns and `shard`, `slot`, which replace input columns of these names.

    Nulls in any column are allowed; copies of a row are dealt apart. An empty table gives an empty result.
    """
    return sharding.shuffle_into_shards(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", good_quality), ("simhash_near_dedup", one_of_near_copies), ("benchmark_decontamination", without_benchmark),
    ("mixing_to_weights", mixed), ("sharding", sharded),
]
# Learned scores, XXH64 fingerprints and hashed draws are not SQL; the tests compare with a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
