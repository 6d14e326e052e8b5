"""One key with a third of all rows."""

from pyspark.sql import functions as F

from creditloom.plans.features import instalment_features, pos_features


def test_aqe_splits_the_hot_order(spark, tmp_path):
    """Line items of one huge order join their order in several tasks, and nothing is lost."""
    lines = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("l_orderkey"), F.col("id").alias("line"),
        F.sha2(F.col("id").cast("string"), 512).alias("pad"))
    lines.repartition(16).write.parquet(str(tmp_path / "lines"))
    spark.range(300_000).select(F.col("id").alias("o_orderkey"), (F.col("id") % 10).alias("d")).write.parquet(str(tmp_path / "orders"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        a, b = spark.read.parquet(str(tmp_path / "lines")), spark.read.parquet(str(tmp_path / "orders"))
        joined = a.join(b, a.l_orderkey == b.o_orderkey).select("l_orderkey", "line", "d", "pad")
        out = joined.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.max("pad"))
        total = sum(r["n"] for r in out.collect())
        assert total == 300_000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_client_is_combined_before_the_shuffle(spark):
    rows = spark.range(60_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("SK_ID_CURR"), (F.col("id") % 12).cast("int").alias("MONTHS_BALANCE"),
        F.lit(1).alias("SK_DPD"), F.lit(0).alias("SK_DPD_DEF"), F.lit("Active").alias("NAME_CONTRACT_STATUS"))
    out = pos_features(rows, {"NAME_CONTRACT_STATUS": ["Active", None]})
    assert out.filter("SK_ID_CURR = 1").first()["POS_COUNT"] == 20_001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.count("Exchange hashpartitioning") == 1


def test_distinct_count_of_a_hot_client(spark):
    rows = spark.range(30_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("SK_ID_CURR"), (F.col("id") % 7).cast("double").alias("NUM_INSTALMENT_VERSION"),
        F.lit(10.0).alias("AMT_INSTALMENT"), F.lit(4.0).alias("AMT_PAYMENT"), F.lit(-5.0).alias("DAYS_INSTALMENT"), F.lit(-3.0).alias("DAYS_ENTRY_PAYMENT"))
    row = instalment_features(rows, {}).filter("SK_ID_CURR = 1").first()
    assert (row["INSTAL_NUM_INSTALMENT_VERSION_NUNIQUE"], row["INSTAL_DPD_SUM"], row["INSTAL_PAYMENT_DIFF_MEAN"]) == (7, 20_002.0, 6.0)
