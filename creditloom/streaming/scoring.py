"""Score arriving applications as a stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from creditloom.functions.columns import decision
from creditloom.operators.cleaning import payload_nulls


def arriving(spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 100) -> DataFrame:
    """Files that land in a folder. The schema is explicit; the batch size is bounded."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern) \
        .option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def score_stream(requests: DataFrame, predict: Callable[[DataFrame], DataFrame], threshold: float, key: str = "SK_ID_CURR",
                 features: DataFrame | None = None) -> DataFrame:
    """(client_id, proba, prediction, threshold) per request.

    `features` is the static feature table for requests that carry only an id (stream-static join);
    `predict` adds PROBA. Stateless, so no watermark; a replaying source goes through `deduplicated` first.
    """
    rows = payload_nulls(requests)
    if features is not None:
        rows = rows.join(features, key, "left")
    scored = predict(rows)
    return scored.select(F.col(key).alias("client_id"), F.col("PROBA").alias("proba"),
                         decision(F.col("PROBA"), threshold).alias("prediction"), F.lit(threshold).alias("threshold"))


def deduplicated(requests: DataFrame, keys: Sequence[str], event_time: str, delay: str = "10 minutes") -> DataFrame:
    """Each request of a replaying source once.

    The watermark follows the latest event time, `delay` behind. Keys are remembered until it has passed them, so the state is bounded by the
    requests of `delay`; what comes later than that is dropped here, a repeat or not, and found again by `unscored`.
    """
    return requests.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def unscored(delivered: DataFrame, scored: DataFrame, keys: Sequence[str], scored_keys: Sequence[str] | None = None) -> DataFrame:
    """Delivered requests, each once, that no score exists for: those that came too late for the stream. For a batch run behind it."""
    names = list(scored_keys or keys)
    done = scored.select(*[F.col(s).alias(k) for s, k in zip(names, keys, strict=True)])
    return delivered.dropDuplicates(list(keys)).join(done, list(keys), "left_anti")


def folder_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """Files that land anywhere below a folder."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def start(scored: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Append to Parquet, exactly once through the checkpoint."""
    writer = scored.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
