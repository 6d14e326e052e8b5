"""Feature-engineering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog import views as V
from creditloom.catalog.registry import query, settled
from creditloom.functions.columns import finite, hm, hms
from creditloom.functions.naming import clean_names
from creditloom.operators.encoding import category_dictionary, label_encode, one_hot
from creditloom.operators import partials
from creditloom.operators.lookup import unmatched
from creditloom.plans import features as P
from creditloom.plans import specs as S
from creditloom.plans.preparation import clean_and_split, new_loan_features
from creditloom.plans.training import build
from creditloom.session import scratch_path
from creditloom.sources import layout
from creditloom.sources import starschema as star


@query("app_ratios", V.using("rated", """
SELECT SK_ID_CURR, round(CREDIT_TO_ANNUITY_RATIO, 6) AS CREDIT_TO_ANNUITY_RATIO, round(CREDIT_TO_GOODS_RATIO, 6) AS CREDIT_TO_GOODS_RATIO,
  round(ANNUITY_TO_INCOME_RATIO, 6) AS ANNUITY_TO_INCOME_RATIO, round(CREDIT_TO_INCOME_RATIO, 6) AS CREDIT_TO_INCOME_RATIO,
  round(INCOME_TO_BIRTH_RATIO, 6) AS INCOME_TO_BIRTH_RATIO FROM rated"""))
def app_ratios(spark, sf):
    out = P.application_features(star.application(spark, sf), categories={})
    return settled(out.select("SK_ID_CURR", *S.APPLICATION_RATIOS))


@query("recode_sentinel", V.using("coded", """
SELECT SK_ID_CURR, CODE_GENDER, FLAG_OWN_CAR, FLAG_OWN_REALTY, EMERGENCYSTATE_MODE, DAYS_EMPLOYED, NAME_INCOME_TYPE FROM coded"""))
def recode_sentinel(spark, sf):
    return P.recode_application(star.application(spark, sf)).select(
        "SK_ID_CURR", *S.APPLICATION_CODES, "DAYS_EMPLOYED", "NAME_INCOME_TYPE")


@query("recode_null_markers", V.using("coded", """
SELECT SK_ID_CURR, CODE_GENDER, EMERGENCYSTATE_MODE, nullif(DAYS_LAST_PHONE_CHANGE, 0) AS DAYS_LAST_PHONE_CHANGE FROM coded"""))
def recode_null_markers(spark, sf):
    return P.recode_application(star.application(spark, sf), null_markers=True).select(
        "SK_ID_CURR", "CODE_GENDER", "EMERGENCYSTATE_MODE", "DAYS_LAST_PHONE_CHANGE")


def _flags(source: str, clean: bool, skip_first: bool = False) -> str:
    out = []
    for c, values in V.CATEGORIES[source].items():
        for v in values[1:] if skip_first else values:
            name = f"{c}_{'nan' if v is None else v}"
            name = V.re.sub("[^A-Za-z0-9_]+", "", name) if clean else name
            out.append(f'{V.flag(c, v)} AS "{name}"')
    return ", ".join(out)


@query("onehot_nullcat", V.using("bureau", f"SELECT SK_ID_BUREAU, {_flags('bureau', False)} FROM bureau"))
def onehot_nullcat(spark, sf):
    df = star.bureau(spark, sf).select("SK_ID_BUREAU", "CREDIT_ACTIVE", "CREDIT_TYPE")
    return one_hot(df, category_dictionary(df))[0]


@query("clean_names", V.using("bureau", f"SELECT SK_ID_BUREAU, {_flags('bureau', True)} FROM bureau"))
def cleaned_names(spark, sf):
    return clean_names(onehot_nullcat(spark, sf))


@query("onehot_drop_first", V.using("coded", f"SELECT SK_ID_CURR, {_flags('app', False, True)} FROM coded"))
def onehot_drop_first(spark, sf):
    df = P.recode_application(star.application(spark, sf)).select("SK_ID_CURR", "NAME_INCOME_TYPE")
    return one_hot(df, category_dictionary(df), drop_first=True)[0]


@query("label_encode", V.using("bureau", """
SELECT b.SK_ID_BUREAU, CAST(coalesce(c.code, -1) AS INTEGER) AS CREDIT_TYPE FROM bureau b
LEFT JOIN (SELECT CREDIT_TYPE, dense_rank() OVER (ORDER BY CREDIT_TYPE) - 1 AS code FROM bureau WHERE CREDIT_TYPE IS NOT NULL GROUP BY 1) c
  ON b.CREDIT_TYPE = c.CREDIT_TYPE"""))
def label_encoded(spark, sf):
    df = star.bureau(spark, sf).select("SK_ID_BUREAU", "CREDIT_TYPE")
    return label_encode(df, category_dictionary(df, ["CREDIT_TYPE"]))


_MONTHS = V.grouped("SK_ID_BUREAU", "balance", [
    *V.measures("", S.BALANCE_MEASURES, digits=None), *V.shares("", V.CATEGORIES["balance"], digits=None)])
_JOINED = "SELECT * FROM bureau LEFT JOIN months USING (SK_ID_BUREAU)"
_STATUS_SHARES = {f"{c}_{'nan' if v is None else v}_MEAN": ["mean"] for c, vs in V.CATEGORIES["balance"].items() for v in vs}


@query("balance_rollup", V.using("balance", V.grouped("SK_ID_BUREAU", "balance", [
    *V.measures("", S.BALANCE_MEASURES), *V.shares("", V.CATEGORIES["balance"])])))
def balance_rollup(spark, sf):
    return settled(P.balance_rollup(star.bureau_balance(spark, sf)))


def _bureau_sql(clean: bool) -> str:
    return V.grouped("SK_ID_CURR", "joined", [
        *V.measures("BURO_", S.BUREAU_MEASURES), *V.measures("BURO_", _STATUS_SHARES),
        *V.shares("BURO_", V.CATEGORIES["bureau"], clean=clean),
        *V.measures("ACTIVE_", S.BUREAU_MEASURES, "CREDIT_ACTIVE = 'Active'"),
        *V.measures("CLOSED_", S.BUREAU_MEASURES, "CREDIT_ACTIVE = 'Closed'")])


@query("bureau_rollup", V.using("bureau balance", _bureau_sql(False), months=_MONTHS, joined=_JOINED))
def bureau_rollup(spark, sf):
    return settled(P.bureau_features(star.bureau(spark, sf), star.bureau_balance(spark, sf)))


def _subset_join(source: str, spec: dict, parts: dict[str, str]) -> str:
    """The filter, aggregate, join-back form of subset statistics."""
    joins = " ".join(
        f"LEFT JOIN ({V.grouped('SK_ID_CURR', f'(SELECT * FROM {source} WHERE {where})', V.measures(prefix, spec))}) USING (SK_ID_CURR)"
        for prefix, where in parts.items())
    return f"SELECT * FROM (SELECT DISTINCT SK_ID_CURR FROM {source}) {joins}"


@query("active_closed_subset", V.using(
    "bureau balance", _subset_join("joined", S.BUREAU_MEASURES, {"ACTIVE_": "CREDIT_ACTIVE = 'Active'", "CLOSED_": "CREDIT_ACTIVE = 'Closed'"}),
    months=_MONTHS, joined=_JOINED))
def active_closed_subset(spark, sf):
    out = P.bureau_features(star.bureau(spark, sf), star.bureau_balance(spark, sf))
    return settled(out.select("SK_ID_CURR", *[c for c in out.columns if c.startswith(("ACTIVE_", "CLOSED_"))]))


def _previous_sql(clean: bool) -> str:
    return V.grouped("SK_ID_CURR", "prev", [
        *V.measures("PREV_", S.PREVIOUS_MEASURES), *V.shares("PREV_", V.CATEGORIES["prev"], clean=clean),
        *V.measures("APPROVED_", S.PREVIOUS_MEASURES, "NAME_CONTRACT_STATUS = 'Approved'"),
        *V.measures("REFUSED_", S.PREVIOUS_MEASURES, "NAME_CONTRACT_STATUS = 'Refused'")])


@query("prev_rollup", V.using("prev", _previous_sql(False)))
def prev_rollup(spark, sf):
    return settled(P.previous_features(star.previous_application(spark, sf)))


@query("approved_refused_subset", V.using("prev", _subset_join("prev", S.PREVIOUS_MEASURES, {
    "APPROVED_": "NAME_CONTRACT_STATUS = 'Approved'", "REFUSED_": "NAME_CONTRACT_STATUS = 'Refused'"})))
def approved_refused_subset(spark, sf):
    out = P.previous_features(star.previous_application(spark, sf))
    return settled(out.select("SK_ID_CURR", *[c for c in out.columns if c.startswith(("APPROVED_", "REFUSED_"))]))


@query("prev_sentinels", V.using("prev", f"""
SELECT SK_ID_CURR, {', '.join(f'count({c}) AS n_{c}, min({c}) AS min_{c}, max({c}) AS max_{c}' for c in S.PREVIOUS_SENTINELS)}
FROM prev GROUP BY SK_ID_CURR"""))
def prev_sentinels(spark, sf):
    df = P.with_previous_ratios(star.previous_application(spark, sf))
    return df.groupBy("SK_ID_CURR").agg(*[
        f(c).alias(f"{n}_{c}") for c in S.PREVIOUS_SENTINELS for n, f in (("n", F.count), ("min", F.min), ("max", F.max))])


_POS_SQL = [*V.measures("POS_", S.POS_MEASURES), *V.shares("POS_", V.CATEGORIES["pos"]), "count(*) AS POS_COUNT"]
_INSTAL_SQL = [*V.measures("INSTAL_", S.INSTALMENT_MEASURES), "count(*) AS INSTAL_COUNT"]
_CARD_NUMERIC = ["MONTHS_BALANCE", "AMT_BALANCE", "AMT_PAYMENT_CURRENT", "CNT_DRAWINGS_CURRENT"]
_CARD_SQL = [*V.measures("CC_", {c: S.CARD_NUMERIC_FUNCS for c in _CARD_NUMERIC}),
             *V.shares("CC_", V.CATEGORIES["card"], S.CARD_CATEGORY_FUNCS), "count(*) AS CC_COUNT"]


@query("pos_rollup", V.using("pos", V.grouped("SK_ID_CURR", "pos", _POS_SQL)))
def pos_rollup(spark, sf):
    return settled(P.pos_features(star.pos_cash(spark, sf)))


@query("instal_rollup", V.using("instal", V.grouped("SK_ID_CURR", "instal", _INSTAL_SQL)))
def instal_rollup(spark, sf):
    return settled(P.instalment_features(star.instalments(spark, sf)))


@query("instal_strict_inf", V.using("instal", """
SELECT SK_ID_CURR, CASE WHEN bool_or(AMT_INSTALMENT = 0 AND AMT_PAYMENT > 0) THEN NULL ELSE round(avg(PAYMENT_PERC), 6) END AS INSTAL_PAYMENT_PERC_MEAN,
  CASE WHEN bool_or(AMT_INSTALMENT = 0 AND AMT_PAYMENT > 0) THEN NULL ELSE round(max(PAYMENT_PERC), 6) END AS INSTAL_PAYMENT_PERC_MAX
FROM instal GROUP BY SK_ID_CURR"""))
def instal_strict_inf(spark, sf):
    out = P.instalment_features(star.instalments(spark, sf), strict_inf=True)
    names = ["INSTAL_PAYMENT_PERC_MEAN", "INSTAL_PAYMENT_PERC_MAX"]
    return settled(out.select("SK_ID_CURR", *[finite(F.col(c)).alias(c) for c in names]))


@query("payment_gaps", V.using("instal", """
SELECT NUM_INSTALMENT_VERSION, count(*) AS n, count(PAYMENT_PERC) AS n_perc, sum(PAYMENT_DIFF) AS diff, sum(DPD) AS dpd, sum(DBD) AS dbd,
  count(*) FILTER (WHERE DPD > 0 AND DBD > 0) AS n_both FROM instal GROUP BY 1"""))
def payment_gaps(spark, sf):
    df = P.with_payment_gaps(star.instalments(spark, sf))
    return df.groupBy("NUM_INSTALMENT_VERSION").agg(
        F.count(F.lit(1)).alias("n"), F.count("PAYMENT_PERC").alias("n_perc"), F.sum("PAYMENT_DIFF").alias("diff"),
        F.sum("DPD").alias("dpd"), F.sum("DBD").alias("dbd"),
        F.count(F.when((F.col("DPD") > 0) & (F.col("DBD") > 0), 1)).alias("n_both"))


@query("card_rollup", V.using("card", V.grouped("SK_ID_CURR", "card", _CARD_SQL)))
def card_rollup(spark, sf):
    return settled(P.card_features(star.card_balance(spark, sf)))


def _by_states(spark, rows, spec, batch):
    """The roll-up through stored states: the older batches make a stored total, the newest is read alone and merged with it."""
    path, totals = scratch_path(spark, "states"), scratch_path(spark, "totals")
    batches = ["0", "1", "2"]
    for b in batches:
        partials.write_batch(partials.states(rows.filter(batch == int(b)), P.KEY, spec), path, b)
    partials.write_batch(partials.merged(partials.read_batches(spark, path, batches[:2]), P.KEY, spec), totals, "1")
    old, new = partials.read_batches(spark, totals, ["1"]), partials.read_batches(spark, path, batches[2:])
    return settled(partials.finished(partials.merged(old.unionByName(new), P.KEY, spec), P.KEY, spec))


@query("merged_previous", V.using("prev", _previous_sql(False)))
def merged_previous(spark, sf):
    rows = P.with_previous_ratios(star.previous_application(spark, sf))
    return _by_states(spark, rows, P.previous_spec(category_dictionary(rows)), F.pmod("DAYS_DECISION", F.lit(3)))


@query("merged_instalments", V.using("instal", V.grouped("SK_ID_CURR", "instal", _INSTAL_SQL)))
def merged_instalments(spark, sf):
    rows = P.with_payment_gaps(star.instalments(spark, sf))
    return _by_states(spark, rows, P.instalment_spec(category_dictionary(rows)), F.pmod(F.col("DAYS_INSTALMENT").cast("int"), F.lit(3)))


@query("merged_card", V.using("card", V.grouped("SK_ID_CURR", "card", _CARD_SQL)))
def merged_card(spark, sf):
    rows = star.card_balance(spark, sf).drop("SK_ID_PREV")
    return _by_states(spark, rows, P.card_spec(rows, category_dictionary(rows)), F.pmod("MONTHS_BALANCE", F.lit(3)))


_APP_COLUMNS = ["SK_ID_CURR", "CODE_GENDER", "FLAG_OWN_CAR", "FLAG_OWN_REALTY", "EMERGENCYSTATE_MODE", "DAYS_EMPLOYED", "DAYS_BIRTH",
                "DAYS_LAST_PHONE_CHANGE", "AMT_CREDIT", "AMT_ANNUITY", "AMT_GOODS_PRICE", "AMT_INCOME_TOTAL"]
_RATIO_SQL = [f"round({c}, 6) AS {c}" for c in S.APPLICATION_RATIOS]
_SATELLITE_SQL = {
    "months": _MONTHS, "joined": _JOINED, "f_bureau": _bureau_sql(True), "f_prev": _previous_sql(True),
    "f_pos": V.grouped("SK_ID_CURR", "pos", _POS_SQL), "f_instal": V.grouped("SK_ID_CURR", "instal", _INSTAL_SQL),
    "f_card": V.grouped("SK_ID_CURR", "card", _CARD_SQL)}
_JOIN_ALL = "LEFT JOIN f_bureau USING (SK_ID_CURR) LEFT JOIN f_prev USING (SK_ID_CURR) LEFT JOIN f_pos USING (SK_ID_CURR) " \
            "LEFT JOIN f_instal USING (SK_ID_CURR) LEFT JOIN f_card USING (SK_ID_CURR)"
_FEATURE_SQL = V.using(
    "rated bureau balance prev pos instal card", f"SELECT * FROM f_app {_JOIN_ALL}",
    f_app=f"SELECT {', '.join([*_APP_COLUMNS, 'TARGET', *_RATIO_SQL])}, {_flags('app', True, True)} FROM rated", **_SATELLITE_SQL)


@query("feature_table", _FEATURE_SQL)
def feature_table(spark, sf):
    return settled(P.feature_table(star.loan_tables(spark, sf)))


@query("stored_feature_table", _FEATURE_SQL)
def stored_feature_table(spark, sf):
    """The same from tables bucketed by client, once they are written; clients with more than a thousand rows in a table are built apart."""
    path = scratch_path(spark, "layout")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = layout.store(star.loan_tables(spark, sf), path, f"layout_{path[-32:]}", buckets, hot_rows=1000)
    return settled(layout.stored_feature_table(stored))


# A training list as it is after selection: one category new data never shows, one extra ratio.
NEW_LOAN_FEATURES = [
    "CODE_GENDER", "AMT_ANNUITY", "DAYS_EMPLOYED", "CREDIT_TO_ANNUITY_RATIO", "NAME_INCOME_TYPE_BUILDING", "NAME_INCOME_TYPE_MACHINERY",
    "NAME_INCOME_TYPE_RETIRED", "BURO_DAYS_CREDIT_MAX", "ACTIVE_AMT_CREDIT_SUM_SUM", "PREV_CNT_PAYMENT_SUM", "POS_COUNT", "INSTAL_DPD_MEAN"]
NEW_LOAN_TYPES = {f: "double" for f in NEW_LOAN_FEATURES}


@query("align_new_loans", V.using(
    "new_app bureau balance prev pos instal card", f"""
SELECT SK_ID_CURR, CAST(CASE CODE_GENDER WHEN 'M' THEN 0 WHEN 'F' THEN 1 END AS DOUBLE) AS CODE_GENDER, AMT_ANNUITY,
  CAST(nullif(DAYS_EMPLOYED, 365243) AS DOUBLE) AS DAYS_EMPLOYED, round(AMT_CREDIT / nullif(AMT_ANNUITY, 0), 6) AS CREDIT_TO_ANNUITY_RATIO,
  CAST(CASE WHEN NAME_INCOME_TYPE = 'BUILDING' THEN 1 ELSE 0 END AS DOUBLE) AS NAME_INCOME_TYPE_BUILDING,
  CAST(0 AS DOUBLE) AS NAME_INCOME_TYPE_MACHINERY, CAST(0 AS DOUBLE) AS NAME_INCOME_TYPE_RETIRED,
  CAST(BURO_DAYS_CREDIT_MAX AS DOUBLE) AS BURO_DAYS_CREDIT_MAX, ACTIVE_AMT_CREDIT_SUM_SUM, PREV_CNT_PAYMENT_SUM,
  CAST(POS_COUNT AS DOUBLE) AS POS_COUNT, INSTAL_DPD_MEAN FROM new_app {_JOIN_ALL}""", **_SATELLITE_SQL))
def align_new_loans(spark, sf):
    from dataclasses import replace

    tables = star.loan_tables(spark, sf)
    # Dictionaries come from the training tables; an unseen category then simply has no column.
    trained = P.Categories()
    trained.of("application", P.recode_application(tables.application))
    new = replace(tables, application=star.new_application(spark, sf))
    return settled(new_loan_features(new, NEW_LOAN_FEATURES, trained, NEW_LOAN_TYPES)[0])


@query("clean_and_split", V.using("rated", """
SELECT SK_ID_CURR, TARGET, CODE_GENDER, AMT_CREDIT, round(CREDIT_TO_ANNUITY_RATIO, 6) AS CREDIT_TO_ANNUITY_RATIO,
  CAST(row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR)
    <= round(count(*) OVER (PARTITION BY TARGET) * 0.25) AS INTEGER) AS is_test FROM rated"""))
def cleaned_split(spark, sf):
    features = P.application_features(star.application(spark, sf))
    constant = features.withColumns({"FLAG_CONSTANT": F.lit(1), "AMT_EMPTY": F.lit(None).cast("double")})
    out = clean_and_split(constant)
    assert "FLAG_CONSTANT" in out.constant and "AMT_EMPTY" in out.empty
    return settled(out.data.select("SK_ID_CURR", "TARGET", "CODE_GENDER", "AMT_CREDIT", "CREDIT_TO_ANNUITY_RATIO", "is_test"))


@query("missing_satellite", V.using("app pos", "SELECT SK_ID_CURR FROM app WHERE SK_ID_CURR NOT IN (SELECT SK_ID_CURR FROM pos)"))
def missing_satellite(spark, sf):
    return unmatched(star.application(spark, sf), star.pos_cash(spark, sf))


_S = "CAST(floor(o_totalprice) AS BIGINT)"


@query("duration_text", f"""
SELECT o_orderkey, CASE WHEN s >= 86400 THEN CAST(s // 86400 AS VARCHAR) || CASE WHEN s // 86400 = 1 THEN ' day, ' ELSE ' days, ' END ELSE '' END
  || printf('%d:%02d:%02d', s % 86400 // 3600, s % 3600 // 60, s % 60) AS hms, printf('%02d:%02d', m // 60, m % 60) AS hm
FROM (SELECT o_orderkey, {_S} AS s, CAST(round_even({_S} / 60.0, 0) AS BIGINT) AS m FROM orders)""")
def duration_text(spark, sf):
    seconds = F.floor("o_totalprice").cast("double")
    return star.read(spark, sf, "orders").select("o_orderkey", hms(seconds).alias("hms"), hm(seconds).alias("hm"))


@query("training_set", V.using("rated", """
SELECT is_test, TARGET, count(*) AS n, sum(AMT_CREDIT) AS amount FROM (
  SELECT TARGET, AMT_CREDIT, CAST(row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR)
    <= round(count(*) OVER (PARTITION BY TARGET) * 0.25) AS INTEGER) AS is_test FROM rated) GROUP BY 1, 2"""))
def training_set(spark, sf):
    built = build(star.loan_tables(spark, sf), scratch_path(spark, "training"))
    parts = [built.part(i).select(F.lit(i).alias("is_test"), "TARGET", F.col("AMT_CREDIT").cast("double").alias("AMT_CREDIT")) for i in (0, 1)]
    return parts[0].unionByName(parts[1]).groupBy("is_test", "TARGET").agg(F.count(F.lit(1)).alias("n"), F.sum("AMT_CREDIT").alias("amount"))
