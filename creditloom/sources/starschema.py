"""Loan-domain views of a customer / orders / lineitem / events star schema.

Each view is a projection (one join for instalments), so column pruning and filters still reach the
Parquet scan. Amounts are whole currency units.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.hashing import key_unit
from creditloom.plans.features import LoanTables

REFERENCE_DAY = "2001-12-31"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _days(c: str) -> Column:
    return F.datediff(F.col(c), F.lit(REFERENCE_DAY).cast("date"))


def _applicants(df: DataFrame, key: Column, bal: Column, nation: Column, income: Column, *more: Column) -> DataFrame:
    return df.select(
        key.alias("SK_ID_CURR"),
        *more,
        F.when(key % 50 == 7, "XNA").when(key % 3 == 0, "M").otherwise("F").alias("CODE_GENDER"),
        F.when(key % 2 == 0, "Y").otherwise("N").alias("FLAG_OWN_CAR"),
        F.when(key % 5 < 3, "Y").otherwise("N").alias("FLAG_OWN_REALTY"),
        F.when(key % 4 == 1, "Yes").when(key % 4 > 1, "No").alias("EMERGENCYSTATE_MODE"),
        F.when(key % 11 == 0, 365243).otherwise(-(key % 9000)).cast("int").alias("DAYS_EMPLOYED"),
        (-7000 - key % 18000).cast("int").alias("DAYS_BIRTH"),
        (-(key % 400)).cast("int").alias("DAYS_LAST_PHONE_CHANGE"),
        (F.floor(bal) * 20 + 250000).cast("double").alias("AMT_CREDIT"),
        F.nullif(nation * 1000.0, F.lit(3000.0)).alias("AMT_ANNUITY"),
        (F.floor(bal) * 18 + 200000).cast("double").alias("AMT_GOODS_PRICE"),
        ((nation % 7) * 15000.0).alias("AMT_INCOME_TOTAL"),
        income.alias("NAME_INCOME_TYPE"),
    )


def application(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, bal = F.col("c_custkey"), F.col("c_acctbal")
    income = F.when(key % 13 == 5, "Unknown").otherwise(F.col("c_mktsegment"))
    return _applicants(read(spark, sf_dir, "customer"), key, bal, F.col("c_nationkey"), income,
                       (bal < 0).cast("int").alias("TARGET"))


def new_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New loans: suppliers as applicants, without a target and with an income type never trained on."""
    key = F.col("s_suppkey")
    income = F.when(key % 3 == 0, "BUILDING").otherwise("STARTUP")
    return _applicants(read(spark, sf_dir, "supplier"), key, F.col("s_acctbal"), F.col("s_nationkey"), income)


def bureau(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price, status = F.col("o_orderkey"), F.floor("o_totalprice").cast("double"), F.col("o_orderstatus")
    opened = _days("o_orderdate")
    return read(spark, sf_dir, "orders").select(
        key.alias("SK_ID_BUREAU"),
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.when(status == "O", "Active").when(status == "F", "Closed").when(status == "P", "Sold").alias("CREDIT_ACTIVE"),
        F.when(key % 9 != 4, F.col("o_orderpriority")).alias("CREDIT_TYPE"),
        opened.alias("DAYS_CREDIT"),
        F.when(status != "P", opened + 730).cast("double").alias("DAYS_CREDIT_ENDDATE"),
        (opened + 30).alias("DAYS_CREDIT_UPDATE"),
        F.when(key % 20 == 3, key % 90).otherwise(0).cast("int").alias("CREDIT_DAY_OVERDUE"),
        F.when(key % 4 == 0, F.floor(price / 100)).cast("double").alias("AMT_CREDIT_MAX_OVERDUE"),
        price.alias("AMT_CREDIT_SUM"),
        F.when(status == "O", F.floor(price / 2)).when(status == "F", 0).cast("double").alias("AMT_CREDIT_SUM_DEBT"),
        F.when(key % 20 == 3, F.floor(price / 50)).otherwise(0).cast("double").alias("AMT_CREDIT_SUM_OVERDUE"),
        F.when(key % 3 == 1, F.floor(price / 4)).cast("double").alias("AMT_CREDIT_SUM_LIMIT"),
        F.when(key % 7 != 2, F.floor(price / 12)).cast("double").alias("AMT_ANNUITY"),
        (key % 3).cast("int").alias("CNT_CREDIT_PROLONG"),
    )


def bureau_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("SK_ID_BUREAU"),
        (-F.col("l_linenumber")).alias("MONTHS_BALANCE"),
        F.col("l_returnflag").alias("STATUS"),
    )


def previous_application(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price, status = F.col("o_orderkey"), F.floor("o_totalprice").cast("double"), F.col("o_orderstatus")
    decided = _days("o_orderdate")

    def sentinel(mod: int, offset: int) -> Column:
        return F.when(key % mod == 0, 365243).otherwise(decided + offset).cast("double")

    return read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("SK_ID_CURR"),
        F.when(status == "F", "Approved").when(status == "P", "Refused").otherwise("Canceled").alias("NAME_CONTRACT_STATUS"),
        F.col("o_orderpriority").alias("NAME_CONTRACT_TYPE"),
        price.alias("AMT_APPLICATION"),
        F.floor(price * (key % 5) / 4).cast("double").alias("AMT_CREDIT"),
        F.when(status != "P", F.floor(price / 24)).cast("double").alias("AMT_ANNUITY"),
        F.when(key % 2 == 0, F.floor(price / 10)).cast("double").alias("AMT_DOWN_PAYMENT"),
        F.when(key % 6 != 1, price + 500).alias("AMT_GOODS_PRICE"),
        (key % 24).cast("int").alias("HOUR_APPR_PROCESS_START"),
        F.when(key % 2 == 0, (key % 8) / 16).alias("RATE_DOWN_PAYMENT"),
        decided.alias("DAYS_DECISION"),
        F.when(status != "P", (key % 10) * 6).cast("double").alias("CNT_PAYMENT"),
        sentinel(3, 0).alias("DAYS_FIRST_DRAWING"),
        sentinel(5, 30).alias("DAYS_FIRST_DUE"),
        sentinel(7, 365).alias("DAYS_LAST_DUE_1ST_VERSION"),
        sentinel(4, 400).alias("DAYS_LAST_DUE"),
        sentinel(6, 410).alias("DAYS_TERMINATION"),
    )


def pos_cash(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.floor("value")
    return read(spark, sf_dir, "events").select(
        F.col("user_id").alias("SK_ID_CURR"),
        (-(F.col("event_id") % 96)).cast("int").alias("MONTHS_BALANCE"),
        F.when(value > 60, value - 60).otherwise(0).cast("int").alias("SK_DPD"),
        F.when(value > 150, value - 150).otherwise(0).cast("int").alias("SK_DPD_DEF"),
        F.when(F.col("event_id") % 17 != 3, F.col("event_type")).alias("NAME_CONTRACT_STATUS"),
    )


def instalments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items take due date and client from their order.

    The join is one row per line item; when one order owns a third of them AQE splits its partition
    (the roll-up that follows has its own exchange, so the split costs no extra shuffle).
    """
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("SK_ID_CURR"), _days("o_orderdate").alias("ordered"))
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", _days("l_shipdate").alias("shipped"))
    due = F.floor("l_extendedprice").cast("double")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "SK_ID_CURR",
        (F.col("l_linenumber") % 4).cast("double").alias("NUM_INSTALMENT_VERSION"),
        F.when(F.col("l_linenumber") == 7, 0.0).otherwise(due).alias("AMT_INSTALMENT"),
        F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("double").alias("AMT_PAYMENT"),
        (F.col("ordered") + 60).cast("double").alias("DAYS_INSTALMENT"),
        F.col("shipped").cast("double").alias("DAYS_ENTRY_PAYMENT"),
    )


def card_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.floor("value")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("SK_ID_PREV"),
        F.col("user_id").alias("SK_ID_CURR"),
        (-(F.col("event_id") % 60)).cast("int").alias("MONTHS_BALANCE"),
        (value * 10).cast("double").alias("AMT_BALANCE"),
        F.when(F.col("event_type") == "purchase", value).cast("double").alias("AMT_PAYMENT_CURRENT"),
        F.when(F.col("event_type") != "view", value % 5).cast("double").alias("CNT_DRAWINGS_CURRENT"),
        F.col("event_type").alias("NAME_CONTRACT_STATUS"),
    )


def loan_tables(spark: SparkSession, sf_dir: str) -> LoanTables:
    return LoanTables(
        application(spark, sf_dir), bureau(spark, sf_dir), bureau_balance(spark, sf_dir),
        previous_application(spark, sf_dir), pos_cash(spark, sf_dir), instalments(spark, sf_dir),
        card_balance(spark, sf_dir),
    )


def scored_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scored row per client: score correlated with the target, a fold-free md5 noise part."""
    key, bal = F.col("c_custkey"), F.col("c_acctbal")
    proba = F.round(0.7 / (1 + F.exp(bal / 2000)) + 0.3 * key_unit(key, 42), 6)
    return read(spark, sf_dir, "customer").select(
        key.alias("SK_ID_CURR"),
        (bal < 0).cast("int").alias("TARGET"),
        proba.alias("PROBA"),
        bal.alias("BALANCE"),
        F.col("c_nationkey").alias("NATION"),
        F.col("c_mktsegment").alias("SEGMENT"),
    )
