"""Tables stored by client: same features, no exchange, hot clients apart."""

import uuid

from pyspark.sql import functions as F

from creditloom.plans.features import KEY, Categories, LoanTables, feature_table, learned
from creditloom.session import scratch_path
from creditloom.sources import layout
from creditloom.sources import starschema as star


def name():
    return f"t_{uuid.uuid4().hex}"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    """Rounded rows by client; sums of doubles depend on their order."""
    return {r[KEY]: {c: round(v, 6) if isinstance(v, float) else v for c, v in r.asDict().items()} for r in df.collect()}


def agree(left, right):
    one, two = rows(left), rows(right)
    assert sorted(left.columns) == sorted(right.columns) and one.keys() == two.keys()
    wrong = [(k, c) for k in one for c in one[k] if one[k][c] != two[k][c] and not (c.endswith("_VAR") and abs(one[k][c] / two[k][c] - 1) < 1e-9)]
    assert not wrong, wrong[:5]


def test_stored_tables_need_no_exchange(spark, sf):
    stored = layout.store(star.loan_tables(spark, sf), scratch_path(spark, "layout"), name(), 8)
    assert stored.hot is None
    known = learned(stored.whole(), Categories())
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = layout.stored_feature_table(stored, known)
        assert "Exchange" not in plan_of(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    agree(out, feature_table(star.loan_tables(spark, sf)))


def small_tables(spark, sf):
    """One client with many rows; a credit listed twice, one that two clients share, one without a client, and balances of an unknown one."""
    t = star.loan_tables(spark, sf)
    ids = [r[0] for r in t.application.select(KEY).orderBy(KEY).limit(20).collect()]
    few = LoanTables(**{n: df.filter(F.col(KEY).isin(ids)) if KEY in df.columns else df for n, df in layout._each(t).items()})
    busiest = few.previous_application.groupBy(KEY).count().orderBy(F.desc("count"), KEY).first()[0]
    copies = few.previous_application.filter(F.col(KEY) == busiest).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(60)))).drop("copy")
    more = few.previous_application.unionByName(copies)
    one = few.bureau.orderBy("SK_ID_BUREAU").limit(1)
    other = one.withColumn(KEY, F.lit(ids[-1]).cast(few.bureau.schema[KEY].dataType))
    none = one.withColumn(KEY, F.lit(None).cast(few.bureau.schema[KEY].dataType))
    return LoanTables(**{**layout._each(few), "previous_application": more, "bureau": few.bureau.unionByName(one).unionByName(other).unionByName(none)})


def test_hot_clients_are_built_apart(spark, sf):
    tables = small_tables(spark, sf)
    stored = layout.store(tables, scratch_path(spark, "layout"), name(), 4, hot_rows=500)
    assert stored.hot is not None and stored.hot.application.count() == 1 and stored.usual.application.count() == 19
    usual, hot = ({r[0] for r in t.previous_application.select(KEY).distinct().collect()} for t in stored.parts())
    assert usual and hot and not usual & hot
    agree(layout.stored_feature_table(stored), feature_table(tables))


def test_another_session_opens_the_files(spark, sf):
    path, first, second = scratch_path(spark, "layout"), name(), name()
    layout.store(small_tables(spark, sf), path, first, 4)
    again = layout.opened(spark, path, second)
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {second}_bureau").collect()}
    assert described["Num Buckets"] == "4" and KEY in described["Bucket Columns"]
    assert "Exchange" not in plan_of(again.usual.pos_cash.groupBy(KEY).count())
    agree(layout.stored_feature_table(again), layout.stored_feature_table(layout.opened(spark, path, first)))
