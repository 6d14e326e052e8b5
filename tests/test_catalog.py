"""Registered queries: the contract, the plans and a value check of a few against DuckDB."""

import importlib.util
import re

import pytest

import __spark_entry__ as entry_module
from creditloom import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_contract(spark):
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) >= 120
    # The text operators come with their subpackage, and only with it.
    present = importlib.util.find_spec("creditloom.llm") is not None and importlib.util.find_spec("corpus_pipeline") is not None
    assert sum(bool(re.search(r"^pipeline$|^op\d", n)) for n in queries) == (14 if present else 0)
    out = entry_module.entry(spark)
    assert out.columns[0] == "SK_ID_CURR" and out.count() > 0


@pytest.mark.parametrize("name", ["bureau_rollup", "cv_metrics", "local_topk", "smote_rows", "describe"])
def test_values_at_small_scale(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    df = catalog.QUERIES[name](spark, sf)
    result = con.execute(catalog.ORACLES[name])
    columns = [d[0] for d in result.description]
    want = sorted((tuple(str(x) for _, x in sorted(zip(columns, r))) for r in result.fetchall()))
    got = sorted((tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect()))
    assert sorted(df.columns) == sorted(columns) and got == want


@pytest.mark.parametrize("name", ["bureau_rollup", "feature_table", "cv_metrics", "describe", "local_topk", "kfold_assign", "outlier_flag"])
def test_plans_hold_no_cross_join(spark, sf, name):
    plan = plan_of(catalog.QUERIES[name](spark, sf))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_subset_statistics_cost_one_exchange(spark, sf):
    assert plan_of(catalog.QUERIES["prev_rollup"](spark, sf)).count("Exchange hashpartitioning") == 1


def test_local_ranking_needs_no_window(spark, sf):
    assert "Window" not in plan_of(catalog.QUERIES["local_topk"](spark, sf))


def test_scans_are_pruned(spark, sf):
    plan = plan_of(catalog.QUERIES["balance_rollup"](spark, sf))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_returnflag:string>" in plan
    ids = plan_of(catalog.QUERIES["sorted_ids"](spark, sf))
    assert "ReadSchema: struct<c_custkey:bigint>" in ids


def test_feature_table_shuffles_each_input_once_per_level(spark, sf):
    """Without broadcasts: applications 1, bureau 3 (months, credits, clients), previous 1, point of sale 1,
    card 1, instalments 4 (two sides of the order join, distinct versions, clients). The joins add none."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(catalog.QUERIES["feature_table"](spark, sf))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 11 and "Exchange SinglePartition" not in plan


def test_folds_do_not_gather_a_class(spark, sf):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(catalog.QUERIES["kfold_assign"](spark, sf))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # Rows move once, by class and md5 prefix; the rest moves bucket totals.
    assert plan.count("Exchange hashpartitioning(_group") == 4 and "SinglePartition" not in plan
