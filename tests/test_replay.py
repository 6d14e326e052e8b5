"""Replayed and late deliveries of a stream."""

from pyspark.sql import functions as F

from creditloom.streaming import scoring


def test_state_shrinks_and_late_rows_are_found(spark, tmp_path):
    def delivery(lo, hi, minute):
        return spark.range(lo, hi).select("id", (F.lit(1_000_000 + minute * 60) + F.col("id") % 60).cast("timestamp").alias("ts"), F.lit(1.0).alias("value"))

    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    kept, dropped = [], []
    for i, df in enumerate([delivery(0, 500, 0), delivery(0, 500, 0).union(delivery(500, 600, 60)), delivery(600, 610, 120), delivery(900, 905, 0)]):
        df.write.parquet(f"{folder}/{i}")
        rows = scoring.deduplicated(scoring.folder_stream(spark, folder, df.schema), ["id"], "ts", "10 minutes")
        scored = scoring.score_stream(rows, lambda d: d.withColumn("PROBA", F.lit(0.7)), 0.5, key="id")
        query = scoring.start(scored, out, state, available_now=True)
        query.awaitTermination()
        progress = [p for p in query.recentProgress if p["stateOperators"]]
        kept.append(progress[-1]["stateOperators"][0]["numRowsTotal"])
        dropped.append(sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in progress))
    assert kept[0] == 500
    assert kept[-1] <= 10 and dropped[-1] == 5
    done = spark.read.parquet(out)
    assert done.count() == 610 and done.select("client_id").distinct().count() == 610
    delivered = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    assert sorted(r.id for r in scoring.unscored(delivered, done, ["id"], ["client_id"]).collect()) == list(range(900, 905))
