"""Queries over replayed and late deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog.registry import query, settled
from creditloom.session import scratch_path
from creditloom.streaming import scoring

_SCORE = "1 / (1 + exp(-(value - 50) / 20))"


def _predict(df):
    return df.withColumn("PROBA", 1 / (1 + F.exp(-(F.col("value") - 50) / 20)))


@query("stream_replayed", f"""
SELECT event_id AS client_id, round({_SCORE}, 6) AS proba, CAST({_SCORE} > 0.48 AS INTEGER) AS prediction, CAST(0.48 AS DOUBLE) AS threshold,
  CASE WHEN us < lo + (hi - lo) // 3 AND event_id % 10 = 3 THEN 'batch' ELSE 'stream' END AS scored_by
FROM (SELECT *, epoch_us(ts) AS us FROM events), (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events)""")
def stream_replayed(spark, sf):
    """Requests come in three deliveries, each but the first with a replay of the one before; a tenth of the first one is held back and
    comes at the very end. The stream scores each request once, the batch behind it those that came after the watermark."""
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    at = F.unix_micros(F.col("ts"))
    lo, hi = events.agg(F.min(at), F.max(at)).first()
    third = (hi - lo) // 3
    part = F.least((at - lo) / max(third, 1), F.lit(2)).cast("int")
    slices = [events.where(part == i) for i in range(3)]
    held = slices[0].where("event_id % 10 = 3")
    on_time = [slices[0].where("event_id % 10 <> 3"), *slices[1:]]
    folder, out, state = (scratch_path(spark, f"replay-{name}") for name in ("in", "out", "state"))
    for i, arriving in enumerate([on_time[0], on_time[1].union(on_time[0]), on_time[2].union(on_time[1]), held]):
        arriving.write.parquet(f"{folder}/delivery-{i}")
        requests = scoring.deduplicated(scoring.folder_stream(spark, folder, events.schema), ["event_id"], "ts", "1 hour")
        scoring.start(scoring.score_stream(requests, _predict, 0.48, key="event_id"), out, state, available_now=True).awaitTermination()
    streamed = spark.read.parquet(out)
    delivered = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    late = scoring.score_stream(scoring.unscored(delivered, streamed, ["event_id"], ["client_id"]), _predict, 0.48, key="event_id")
    return settled(streamed.withColumn("scored_by", F.lit("stream")).unionByName(late.withColumn("scored_by", F.lit("batch"))))
