"""Profiling, screening, split and lookup queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog import views as V
from creditloom.catalog.registry import query, settled
from creditloom.functions.columns import decision, ratio
from creditloom.functions.naming import search_names
from creditloom.operators import cleaning as C
from creditloom.operators import lookup as L
from creditloom.operators import profiling as R
from creditloom.operators import splitting as X
from creditloom.operators.importance import name_difference
from creditloom.operators.rollup import columns_of
from creditloom.plans import features as P
from creditloom.sources import starschema as star
from creditloom.sources.io import schema_table

_WIDE = "rated bureau"
_PROFILED = ["EMERGENCYSTATE_MODE", "CODE_GENDER", "AMT_ANNUITY", "DAYS_EMPLOYED", "CREDIT_TO_INCOME_RATIO", "ANNUITY_TO_INCOME_RATIO",
             "POS_COUNT", "DEBT", "CLOSED_DEBT"]
_PROFILE_SQL = """
SELECT r.*, p.POS_COUNT, b.DEBT, b.CLOSED_DEBT, CAST(NULL AS DOUBLE) AS NOTHING, CAST(1 AS INTEGER) AS ALWAYS_ONE FROM rated r
LEFT JOIN (SELECT SK_ID_CURR, count(*) AS POS_COUNT FROM pos GROUP BY 1) p USING (SK_ID_CURR)
LEFT JOIN (SELECT SK_ID_CURR, sum(AMT_CREDIT_SUM_DEBT) AS DEBT,
  sum(AMT_CREDIT_SUM_DEBT) FILTER (WHERE CREDIT_ACTIVE = 'Closed') AS CLOSED_DEBT FROM bureau GROUP BY 1) b USING (SK_ID_CURR)"""


def profiled(spark, sf):
    """A medium table with missing values, one empty and one constant column."""
    debt = star.bureau(spark, sf).groupBy("SK_ID_CURR").agg(
        F.sum("AMT_CREDIT_SUM_DEBT").alias("DEBT"),
        F.sum(F.when(F.col("CREDIT_ACTIVE") == "Closed", F.col("AMT_CREDIT_SUM_DEBT"))).alias("CLOSED_DEBT"))
    counts = star.pos_cash(spark, sf).groupBy("SK_ID_CURR").agg(F.count(F.lit(1)).alias("POS_COUNT"))
    base = P.application_features(star.application(spark, sf), categories={})
    return base.join(counts, "SK_ID_CURR", "left").join(debt, "SK_ID_CURR", "left").withColumns(
        {"NOTHING": F.lit(None).cast("double"), "ALWAYS_ONE": F.lit(1)})


def _on_profile(body: str, names: str = "rated pos bureau", **extra: str) -> str:
    return V.using(names, body, t=_PROFILE_SQL, **extra)


def _each(columns, text: str, source: str = "t") -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {text.format(c=c)} FROM {source}" for c in columns)


_MISSING = _each([*_PROFILED, "NOTHING", "ALWAYS_ONE"], "100.0::DOUBLE * (count(*) - count({c})) / count(*) AS missing_pct")


@query("missing_pct", _on_profile("SELECT feature, round(missing_pct, 6) AS missing_pct FROM m", m=_MISSING))
def missing_pct(spark, sf):
    return settled(_missing(spark, sf))


def _missing(spark, sf):
    return R.missing_pct(profiled(spark, sf), [*_PROFILED, "NOTHING", "ALWAYS_ONE"])


@query("missing_bands", _on_profile("""
SELECT CASE WHEN missing_pct <= 30 THEN 'bottom' WHEN round(missing_pct, 1) >= 100 THEN 'top' ELSE 'middle' END AS band,
  count(*) AS n_features, round(max(missing_pct), 6) AS max_pct FROM m GROUP BY 1""", m=_MISSING))
def missing_bands(spark, sf):
    return settled(R.missing_bands(_missing(spark, sf)))


@query("most_missing", _on_profile("SELECT feature, round(missing_pct, 6) AS missing_pct FROM m ORDER BY 2 DESC, 1 LIMIT 5", m=_MISSING))
def most_missing(spark, sf):
    return settled(R.most_missing(_missing(spark, sf), 5))


@query("missing_by_name", _on_profile("SELECT feature, round(missing_pct, 6) AS missing_pct FROM m ORDER BY 1 LIMIT 5", m=_MISSING))
def missing_by_name(spark, sf):
    return settled(R.most_missing(_missing(spark, sf), 5, by="index"))


_NUMERIC = [*_PROFILED, "ALWAYS_ONE", "NOTHING", "AMT_CREDIT", "FLAG_OWN_CAR"]


@query("variance_screen", _on_profile("SELECT feature, CAST(round(v, 4) AS DOUBLE) AS variance FROM m WHERE v <= 0.25", m=_each(
    _NUMERIC, "var_samp(CAST({c} AS DOUBLE)) AS v")))
def variance_screen(spark, sf):
    out = R.variances(profiled(spark, sf), _NUMERIC).filter("variance <= 0.25")
    return settled(out, 4)


@query("empty_columns", _on_profile(_each(_NUMERIC, "CAST(count({c}) = 0 AS INTEGER) AS is_empty")))
def empty_columns(spark, sf):
    return R.empty_columns(profiled(spark, sf), _NUMERIC)


@query("infinite_columns", V.using("prev instal", """
SELECT 'APP_CREDIT_PERC' AS feature, count(*) FILTER (WHERE AMT_CREDIT = 0 AND AMT_APPLICATION <> 0) AS n_infinite FROM prev"""))
def infinite_columns(spark, sf):
    df = star.previous_application(spark, sf)
    raw = df.select(ratio(F.col("AMT_APPLICATION"), F.col("AMT_CREDIT"), strict_inf=True).alias("APP_CREDIT_PERC"), "AMT_CREDIT")
    return R.infinite_columns(raw)


@query("infinities_to_null", V.using("prev", """
SELECT SK_ID_CURR, count(*) AS n, count(APP_CREDIT_PERC) AS n_known, round(max(APP_CREDIT_PERC), 6) AS top FROM prev GROUP BY 1"""))
def infinities_to_null(spark, sf):
    df = star.previous_application(spark, sf)
    raw = df.select("SK_ID_CURR", ratio(F.col("AMT_APPLICATION"), F.col("AMT_CREDIT"), strict_inf=True).alias("p"))
    return settled(C.infinities_to_null(raw).groupBy("SK_ID_CURR").agg(
        F.count(F.lit(1)).alias("n"), F.count("p").alias("n_known"), F.max("p").alias("top")))


@query("duplicate_keys", "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return R.duplicate_keys(star.read(spark, sf, "lineitem"), "l_orderkey")


@query("min_max", _on_profile(_each(
    _NUMERIC, "round(CAST(min({c}) AS DOUBLE), 6) AS min_value, round(CAST(max({c}) AS DOUBLE), 6) AS max_value")))
def min_max(spark, sf):
    return settled(R.min_max(profiled(spark, sf), _NUMERIC))


_INTS = ["CODE_GENDER", "EMERGENCYSTATE_MODE", "DAYS_BIRTH", "POS_COUNT", "ALWAYS_ONE"]
_FLOATS = ["AMT_CREDIT", "AMT_ANNUITY", "DAYS_EMPLOYED", "DEBT", "INCOME_TO_BIRTH_RATIO", "NOTHING"]
_BOUNDS = "round(CAST(min({c}) AS DOUBLE), 6) AS min_value, round(CAST(max({c}) AS DOUBLE), 6) AS max_value, "


@query("narrow_plan", _on_profile(
    _each(_INTS, _BOUNDS + "CASE WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END AS target_type")
    + " UNION ALL "
    + _each(_FLOATS, _BOUNDS + "CASE WHEN min({c}) >= -3.4028234663852886e38 AND max({c}) <= 3.4028234663852886e38 THEN 'float' ELSE 'double' END AS target_type")))
def narrow_plan(spark, sf):
    return settled(R.narrow_plan(profiled(spark, sf).select(*_INTS, *_FLOATS)))


@query("narrowed_values", _on_profile("""
SELECT SK_ID_CURR, CODE_GENDER, DAYS_BIRTH, CAST(CAST(AMT_CREDIT AS FLOAT) AS DOUBLE) AS AMT_CREDIT, CAST(POS_COUNT AS INTEGER) AS POS_COUNT FROM t"""))
def narrowed_values(spark, sf):
    df = profiled(spark, sf).select("SK_ID_CURR", "CODE_GENDER", "DAYS_BIRTH", "AMT_CREDIT", "POS_COUNT")
    return R.narrow(df, exclude=("SK_ID_CURR",)).withColumn("AMT_CREDIT", F.col("AMT_CREDIT").cast("double"))


_BINARY = [*_INTS, *_FLOATS, "FLAG_OWN_CAR"]


@query("binary_features", _on_profile(_each(
    _BINARY, "CAST(coalesce(bool_and(CAST({c} AS DOUBLE) IN (0, 1)), TRUE) AS INTEGER) AS is_binary")))
def binary_features(spark, sf):
    return R.binary_features(profiled(spark, sf).select(*_BINARY))


@query("binary_to_bool", _on_profile("""
SELECT SK_ID_CURR, CAST(FLAG_OWN_CAR AS BOOLEAN) AS FLAG_OWN_CAR, FLAG_OWN_CAR AS FLAG_SUM, AMT_CREDIT FROM t"""))
def binary_to_bool(spark, sf):
    df = profiled(spark, sf).select("SK_ID_CURR", "FLAG_OWN_CAR", F.col("FLAG_OWN_CAR").alias("FLAG_SUM"), "AMT_CREDIT")
    out = R.binary_to_bool(df)
    assert columns_of(out, "bool") == ["FLAG_OWN_CAR"]
    return out


@query("name_search", """
SELECT 'o_orderdate' AS feature, count(o_orderdate) AS n_known, count(DISTINCT o_orderdate) AS n_values FROM orders
UNION ALL SELECT 'o_totalprice', count(o_totalprice), count(DISTINCT o_totalprice) FROM orders""")
def name_search(spark, sf):
    df = star.read(spark, sf, "orders")
    return R.per_column_structs(df, search_names(df.columns, "DATE|price"), lambda c: {"n_known": f"count({c})", "n_values": f"count(DISTINCT {c})"})


# Written out, so that the SQL form doesn't follow what the Spark side finds.
_LINE_KINDS = {
    "string": ["l_returnflag", "l_linestatus"],
    "float": ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
    "other": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate"],
}


@query("typed_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{kind}' AS kind, count({c}) AS n_known, "
    f"{f'max(length({c}))' if kind == 'string' else 'CAST(NULL AS BIGINT)'} AS longest FROM lineitem" for kind, names in _LINE_KINDS.items() for c in names))
def typed_columns(spark, sf):
    df = star.read(spark, sf, "lineitem")
    texts, floats = columns_of(df, "string"), columns_of(df, "float")

    def facts(c):
        kind = "string" if c.strip("`") in texts else "float" if c.strip("`") in floats else "other"
        longest = f"max(length({c}))" if kind == "string" else "NULL"
        return {"kind": f"'{kind}'", "n_known": f"count({c})", "longest": f"CAST({longest} AS BIGINT)"}

    return R.per_column_structs(df, df.columns, facts)


_ROLES = ["CODE_GENDER", "FLAG_OWN_CAR", "AMT_INCOME_TOTAL", "AMT_CREDIT", "NAME_INCOME_TYPE", "DAYS_BIRTH"]


@query("column_roles", V.using("app", _each(
    _ROLES, "CASE WHEN count(DISTINCT {c}) > 4 THEN 'numeric' ELSE 'categorical' END AS role", "app")))
def column_roles(spark, sf):
    return R.column_roles(star.application(spark, sf), _ROLES)


_DESCRIBED = ["AMT_CREDIT", "DAYS_EMPLOYED", "AMT_ANNUITY", "DEBT"]


@query("describe", _on_profile(_each(_DESCRIBED, """count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  CAST(min({c}) AS DOUBLE) AS min, round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75, CAST(max({c}) AS DOUBLE) AS max""")))
def describe(spark, sf):
    return settled(R.describe(profiled(spark, sf), _DESCRIBED))


@query("drop_incomplete", _on_profile("SELECT SK_ID_CURR, DEBT, POS_COUNT FROM t WHERE DEBT IS NOT NULL AND POS_COUNT IS NOT NULL"))
def drop_incomplete(spark, sf):
    return C.drop_incomplete(profiled(spark, sf).select("SK_ID_CURR", "DEBT", "POS_COUNT"), ["DEBT", "POS_COUNT"])


@query("payload_nulls", V.using("app", """
SELECT SK_ID_CURR, nullif(CASE WHEN CODE_GENDER = 'XNA' THEN 'null' ELSE CODE_GENDER END, 'null') AS CODE_GENDER,
  CASE WHEN AMT_INCOME_TOTAL = 0 THEN NULL ELSE AMT_INCOME_TOTAL END AS AMT_INCOME_TOTAL FROM app"""))
def payload_nulls(spark, sf):
    sent = star.application(spark, sf).select(
        "SK_ID_CURR", F.when(F.col("CODE_GENDER") == "XNA", "null").otherwise(F.col("CODE_GENDER")).alias("CODE_GENDER"),
        F.when(F.col("AMT_INCOME_TOTAL") == 0, float("nan")).otherwise(F.col("AMT_INCOME_TOTAL")).alias("AMT_INCOME_TOTAL"))
    return C.payload_nulls(sent)


@query("decision_label", V.using("scored", "SELECT SK_ID_CURR, PROBA, CAST(PROBA > 0.48 AS INTEGER) AS PREDICTION FROM scored"))
def decision_label(spark, sf):
    return star.scored_population(spark, sf).select("SK_ID_CURR", "PROBA", decision(F.col("PROBA"), 0.48).alias("PREDICTION"))


@query("model_input", _on_profile("""
SELECT SK_ID_CURR, TARGET, CAST(CODE_GENDER AS DOUBLE) AS CODE_GENDER, CAST(FLAG_OWN_CAR AS INTEGER) AS FLAG_OWN_CAR, AMT_CREDIT FROM t"""))
def model_input(spark, sf):
    df = profiled(spark, sf).select("SK_ID_CURR", "TARGET", "CODE_GENDER", F.col("FLAG_OWN_CAR").cast("boolean").alias("FLAG_OWN_CAR"), "AMT_CREDIT")
    out = C.for_modelling(df)
    assert not columns_of(out, "bool") and C.predictors(out) == ["CODE_GENDER", "FLAG_OWN_CAR", "AMT_CREDIT"]
    return out


def _split_sql(share: str, into: str) -> str:
    return V.using("scored", f"""
SELECT SK_ID_CURR, TARGET, CAST(row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR)
  <= round(count(*) OVER (PARTITION BY TARGET) * {share}) AS INTEGER) AS {into} FROM scored""")


def _population(spark, sf):
    return star.scored_population(spark, sf).select("SK_ID_CURR", "TARGET")


@query("stratified_split", _split_sql("0.25", "in_sample"))
def stratified_split(spark, sf):
    return X.stratified_split(_population(spark, sf), "SK_ID_CURR", "TARGET", 0.25)


@query("population_sample", _split_sql("0.03", "in_sample"))
def population_sample(spark, sf):
    return X.stratified_split(_population(spark, sf), "SK_ID_CURR", "TARGET", 0.03)


@query("hash_split", V.using("scored", """
SELECT SK_ID_CURR, CAST(CAST('0x' || substr(md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE) < 0.3 AS INTEGER)
  AS in_sample FROM scored"""))
def hash_split(spark, sf):
    return X.hash_split(_population(spark, sf).select("SK_ID_CURR"), "SK_ID_CURR", 0.3)


@query("kfold_assign", V.using("folded", "SELECT SK_ID_CURR, TARGET, fold FROM folded"))
def kfold_assign(spark, sf):
    return X.stratified_folds(_population(spark, sf), "SK_ID_CURR", "TARGET", 5)


@query("single_fold", V.using("scored", "SELECT SK_ID_CURR, TARGET, CAST(0 AS INTEGER) AS fold FROM scored"))
def single_fold(spark, sf):
    return X.single_fold(_population(spark, sf))



@query("split_membership", V.using("scored", """
SELECT SK_ID_CURR, TARGET FROM (SELECT SK_ID_CURR, TARGET, row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR) AS r,
  count(*) OVER (PARTITION BY TARGET) AS n FROM scored) WHERE r > round(n * 0.25)"""))
def split_membership(spark, sf):
    return X.take_part(stratified_split(spark, sf), "in_sample", 0)


@query("split_null_keys", """SELECT c_mktsegment AS segment, count(*) AS n, CAST(round(count(*) * 0.2) AS BIGINT) AS n_in_sample
FROM customer LEFT JOIN (SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'O') ON c_custkey = o_custkey GROUP BY 1""")
def split_null_keys(spark, sf):
    """Customers without an open order have no key; every row still gets its place in the split."""
    orders = spark.read.parquet(f"{sf}/orders.parquet").where("o_orderstatus = 'O'").select("o_orderkey", "o_custkey")
    customers = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    rows = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    split = X.stratified_split(rows, "o_orderkey", "segment", 0.2)
    return split.groupBy("segment").agg(F.count("*").alias("n"), F.sum("in_sample").cast("bigint").alias("n_in_sample"))


@query("id_disjoint", "SELECT count(*) AS n_common FROM customer WHERE c_custkey IN (SELECT user_id FROM events)")
def id_disjoint(spark, sf):
    return L.id_overlap(_population(spark, sf), star.pos_cash(spark, sf))


@query("id_intersection", "SELECT c_custkey AS SK_ID_CURR FROM customer INTERSECT SELECT user_id FROM events")
def id_intersection(spark, sf):
    return L.id_intersection(_population(spark, sf), star.pos_cash(spark, sf))


@query("client_lookup", V.using("scored", """
SELECT r.SK_ID_CURR, s.PROBA, CAST(s.SK_ID_CURR IS NOT NULL AS INTEGER) AS found
FROM (SELECT DISTINCT o_custkey * 2 AS SK_ID_CURR FROM orders) r LEFT JOIN scored s USING (SK_ID_CURR)"""))
def client_lookup(spark, sf):
    requests = star.read(spark, sf, "orders").select((F.col("o_custkey") * 2).alias("SK_ID_CURR")).distinct()
    return L.client_lookup(star.scored_population(spark, sf).select("SK_ID_CURR", "PROBA"), requests)


@query("index_attach", V.using("scored rated", """
SELECT SK_ID_CURR, s.TARGET, AMT_CREDIT FROM scored s JOIN rated USING (SK_ID_CURR)"""))
def index_attach(spark, sf):
    x = star.application(spark, sf).select("SK_ID_CURR", "AMT_CREDIT")
    return x.join(_population(spark, sf), "SK_ID_CURR")


@query("payload_round_trip", V.using("rated", """
SELECT SK_ID_CURR, AMT_CREDIT, round(CREDIT_TO_ANNUITY_RATIO, 6) AS CREDIT_TO_ANNUITY_RATIO, CAST(NULL AS DOUBLE) AS NEVER_SENT FROM rated"""))
def payload_round_trip(spark, sf):
    df = P.application_features(star.application(spark, sf), categories={})
    sent = L.to_payload(df, ["AMT_CREDIT", "CREDIT_TO_ANNUITY_RATIO"])
    return settled(L.from_payload(sent, ["AMT_CREDIT", "CREDIT_TO_ANNUITY_RATIO", "NEVER_SENT"]))


@query("response_rows", V.using("scored", """
SELECT CASE WHEN SK_ID_CURR % 10 <> 9 THEN SK_ID_CURR END AS SK_ID_CURR, CAST(SK_ID_CURR % 10 <> 9 AS INTEGER) AS valid, BALANCE, PROBA,
  CAST(PROBA > 0.48 AS INTEGER) AS PREDICTION FROM scored"""))
def response_rows(spark, sf):
    df = star.scored_population(spark, sf)
    sent_id = F.when(F.col("SK_ID_CURR") % 10 != 9, F.col("SK_ID_CURR"))
    body = F.to_json(F.struct(sent_id.alias("client_id"), F.create_map(F.lit("BALANCE"), F.col("BALANCE")).alias("features"),
                              F.col("PROBA").alias("proba"), decision(F.col("PROBA"), 0.48).alias("prediction")))
    return L.response_rows(df.select(body.alias("body")), "body", ["BALANCE"])


@query("feature_set_difference", V.using("app", """
SELECT feature, side FROM (
  (SELECT DISTINCT 'NAME_INCOME_TYPE_' || NAME_INCOME_TYPE AS feature, 'left' AS side FROM app WHERE NAME_INCOME_TYPE <> 'Unknown'
     AND NAME_INCOME_TYPE NOT IN (SELECT NAME_INCOME_TYPE FROM new_app))
  UNION ALL
  (SELECT DISTINCT 'NAME_INCOME_TYPE_' || NAME_INCOME_TYPE, 'right' FROM new_app
     WHERE NAME_INCOME_TYPE NOT IN (SELECT NAME_INCOME_TYPE FROM app)))""", new_app=V.VIEWS["new_app"]))
def feature_set_difference(spark, sf):
    def names(df):
        known = P.recode_application(df).filter(F.col("NAME_INCOME_TYPE").isNotNull())
        return known.select(F.concat(F.lit("NAME_INCOME_TYPE_"), "NAME_INCOME_TYPE").alias("feature")).distinct()

    return name_difference(names(star.application(spark, sf)), names(star.new_application(spark, sf)))


_ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "o_orderdate": "timestamp",
                "o_orderpriority": "string"}


@query("schema_dictionary", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, '{t}' AS dtype, count(*) - count({c}) AS n_missing FROM orders" for c, t in _ORDER_TYPES.items()))
def schema_dictionary(spark, sf):
    df = star.read(spark, sf, "orders")
    types = {r["feature"]: r["dtype"].replace("_ntz", "") for r in schema_table(df).collect()}
    return R.per_column_structs(df, df.columns, lambda c: {"dtype": f"'{types[c.strip('`')]}'", "n_missing": f"count_if({c} IS NULL)"})


@query("column_lists", _on_profile("SELECT SK_ID_CURR, TARGET, AMT_CREDIT FROM t"))
def column_lists(spark, sf):
    df = profiled(spark, sf)
    kept = C.keep_columns(df, ["AMT_CREDIT", "NOTHING", "ALWAYS_ONE"])
    return C.drop_columns(kept, [r["feature"] for r in R.empty_columns(kept).filter("is_empty = 1").collect()] + ["ALWAYS_ONE", "ABSENT"])
