"""Scan and sink queries: each writes what Spark derives from the tables and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.catalog import views as V
from creditloom.catalog.explanation import FEATURES, _GLOBAL, _LONG, _PHI, _RANKED, _FOLDED, _PER_FOLD, _NULLED, _MISSING, _TABLE
from creditloom.catalog.explanation import contributions, importance_table, table
from creditloom.catalog.registry import query, settled
from creditloom.operators import explain as E
from creditloom.operators import importance as I
from creditloom.operators.splitting import stratified_split
from creditloom.plans.specs import NULL_TOKENS
from creditloom.session import scratch_path
from creditloom.sources import io
from creditloom.sources import starschema as star


@query("csv_null_tokens", V.using("app", """
SELECT SK_ID_CURR, nullif(CODE_GENDER, 'XNA') AS CODE_GENDER, nullif(NAME_INCOME_TYPE, 'Unknown') AS NAME_INCOME_TYPE, AMT_ANNUITY FROM app"""))
def csv_null_tokens(spark, sf):
    df = star.application(spark, sf).select("SK_ID_CURR", "CODE_GENDER", "NAME_INCOME_TYPE", "AMT_ANNUITY")
    path = scratch_path(spark, "application-csv")
    io.write_csv(df, path)
    return io.read_csv(spark, path, df.schema, NULL_TOKENS)


@query("csv_satellite_scan", V.using("bureau", """
SELECT CREDIT_ACTIVE, count(*) AS n, count(CREDIT_TYPE) AS n_typed, sum(AMT_CREDIT_SUM) AS amount, CAST(sum(DAYS_CREDIT) AS BIGINT) AS days FROM bureau GROUP BY 1"""))
def csv_satellite_scan(spark, sf):
    path = scratch_path(spark, "bureau-csv")
    io.write_csv(star.bureau(spark, sf), path)
    return io.read_csv(spark, path).groupBy("CREDIT_ACTIVE").agg(
        F.count(F.lit(1)).alias("n"), F.count("CREDIT_TYPE").alias("n_typed"), F.sum("AMT_CREDIT_SUM").alias("amount"),
        F.sum("DAYS_CREDIT").alias("days"))


@query("train_projection", V.using("scored bureau", "SELECT SK_ID_CURR, TARGET, DEBT, N_CREDITS FROM t", t=_TABLE))
def train_projection(spark, sf):
    path = scratch_path(spark, "train")
    io.write_parquet(table(spark, sf), path)
    return io.read_train(spark, path, ["DEBT", "N_CREDITS"], clean_types=True)


@query("schema_scan", V.using("scored bureau", "SELECT SK_ID_CURR, BALANCE, NATION, N_CREDITS FROM t", t=_TABLE))
def schema_scan(spark, sf):
    df = table(spark, sf).select("SK_ID_CURR", "TARGET", "BALANCE", "NATION", "N_CREDITS")
    data, stored = scratch_path(spark, "scored-csv"), scratch_path(spark, "schema")
    io.write_csv(df, data)
    io.save_schema(df, stored)
    return io.read_with_schema(spark, data, io.load_schema(spark, stored))


@query("sorted_ids", "SELECT c_custkey AS SK_ID_CURR FROM customer ORDER BY 1")
def sorted_ids(spark, sf):
    return io.sorted_ids(star.application(spark, sf))


@query("split_folders", V.using("scored", """
SELECT is_test, TARGET, count(*) AS n FROM (SELECT TARGET, CAST(row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR)
  <= round(count(*) OVER (PARTITION BY TARGET) * 0.25) AS INTEGER) AS is_test FROM scored) GROUP BY 1, 2"""))
def split_folders(spark, sf):
    path = scratch_path(spark, "split")
    parts = stratified_split(star.scored_population(spark, sf), "SK_ID_CURR", "TARGET", 0.25, into="is_test")
    io.save_split(parts, path, "is_test")
    return spark.read.parquet(path).groupBy("is_test", "TARGET").agg(F.count(F.lit(1)).alias("n"))


@query("feature_list_table", V.using(
    "scored bureau", "SELECT 'by_importance' AS list_name, CAST(rank_importance - 1 AS INTEGER) AS pos, feature FROM r",
    t=_TABLE, f=_FOLDED, p=_PER_FOLD, nt=_NULLED, m=_MISSING, r=_RANKED))
def feature_list_table(spark, sf):
    ranked = importance_table(spark, sf).orderBy("rank_importance").collect()
    path = scratch_path(spark, "feature-lists")
    io.write_parquet(io.feature_list_rows(spark, {"by_importance": [r["feature"] for r in ranked]}), path)
    names = io.load_feature_list(spark, path, "by_importance")
    return io.feature_list_rows(spark, {"by_importance": names})


@query("importance_scan", V.using("scored bureau", "SELECT feature, round(importance, 6) AS importance FROM g", t=_TABLE, phi=_PHI, long=_LONG, g=_GLOBAL))
def importance_scan(spark, sf):
    found = I.with_direction(E.global_importance(contributions(spark, sf)[0], FEATURES))
    path = scratch_path(spark, "importances")
    io.write_csv(found, path)
    schema = T.StructType.fromDDL("feature string, importance double, signed_mean double, impact_direction string")
    return settled(io.read_csv(spark, path, schema).select("feature", "importance"))


@query("head_rows", "SELECT c_custkey AS SK_ID_CURR, c_acctbal AS BALANCE FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20")
def head_rows(spark, sf):
    df = star.scored_population(spark, sf).select("SK_ID_CURR", "BALANCE")
    return df.orderBy(F.col("BALANCE").desc(), "SK_ID_CURR").limit(20)
