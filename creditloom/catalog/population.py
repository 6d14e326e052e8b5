"""Population-analysis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog import views as V
from creditloom.catalog.registry import query, settled
from creditloom.functions.columns import decision
from creditloom.operators import narrative as N
from creditloom.operators import partials, sketches
from creditloom.operators import population as P
from creditloom.operators.cleaning import drop_incomplete
from creditloom.session import cut_lineage, scratch_path
from creditloom.sources import starschema as star


def decided(spark, sf):
    return star.scored_population(spark, sf).withColumn("PREDICTION", decision(F.col("PROBA"), 0.48))


_DECIDED = "SELECT *, CAST(PROBA > 0.48 AS INTEGER) AS PREDICTION FROM scored"


def _on(body: str, **extra: str) -> str:
    return V.using("scored", body, d=_DECIDED, **extra)


@query("class_ratio", _on("SELECT TARGET, count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM d) AS DOUBLE), 6) AS share FROM d GROUP BY TARGET"))
def class_ratio(spark, sf):
    return settled(P.class_ratio(decided(spark, sf), "TARGET"))


@query("category_share", _on("""
SELECT SEGMENT, count(*) AS n, round(count(*) / CAST((SELECT count(*) FROM d) AS DOUBLE), 6) AS share, CAST(SEGMENT = 'BUILDING' AS INTEGER) AS is_client
FROM d GROUP BY SEGMENT"""))
def category_share(spark, sf):
    return settled(P.category_share(decided(spark, sf), "SEGMENT", "BUILDING"))


def _histogram_sql(feature: str, by: str = "") -> str:
    group = f"{by}, bin" if by else "bin"
    total = f"sum(count(*)) OVER (PARTITION BY {by})" if by else "sum(count(*)) OVER ()"
    return _on(f"""
SELECT {by + ', ' if by else ''}bin, count(*) AS n, round(any_value(low) + bin * ((any_value(high) - any_value(low)) / 50), 6) AS bin_start,
  round(100 * (count(*) / CAST({total} AS DOUBLE)), 6) AS percent
FROM (SELECT *, CAST(least(floor(({feature} - low) / ((high - low) / 50)), 49) AS INTEGER) AS bin FROM d, bounds) GROUP BY {group}""",
               bounds=f"SELECT min({feature}) AS low, max({feature}) AS high FROM d")


@query("histogram50", _histogram_sql("BALANCE"))
def histogram50(spark, sf):
    return settled(P.histogram(decided(spark, sf), "BALANCE"))


@query("histogram_by_cat", _histogram_sql("BALANCE", "SEGMENT"))
def histogram_by_cat(spark, sf):
    return settled(P.histogram(decided(spark, sf), "BALANCE", by=["SEGMENT"]))


@query("histogram_proba", _histogram_sql("PROBA", "PREDICTION"))
def histogram_proba(spark, sf):
    return settled(P.histogram(decided(spark, sf), "PROBA", by=["PREDICTION"]))


_BOX = """SELECT *, q3 - q1 AS iqr, q1 - 1.5::DOUBLE * (q3 - q1) AS lower, q3 + 1.5::DOUBLE * (q3 - q1) AS upper FROM (
SELECT SEGMENT, count(BALANCE) AS n, quantile_cont(BALANCE, 0.25) AS q1, quantile_cont(BALANCE, 0.5) AS median, quantile_cont(BALANCE, 0.75) AS q3
FROM d GROUP BY SEGMENT)"""


@query("box_stats", _on("""SELECT SEGMENT, n, round(q1, 5) AS q1, round(median, 5) AS median, round(q3, 5) AS q3, round(iqr, 5) AS iqr,
  round("lower", 5) AS "lower", round("upper", 5) AS "upper" FROM b""", b=_BOX))
def box_stats(spark, sf):
    return settled(P.box_stats(decided(spark, sf), "BALANCE", "SEGMENT"), 5)


# Line prices per return flag: a long table whose groups hold a third of all rows each.
@query("box_stats_lines", """
SELECT l_returnflag AS flag, count(*) AS n, round(quantile_cont(l_extendedprice, 0.25), 4) AS q1, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
  round(quantile_cont(l_extendedprice, 0.75), 4) AS q3 FROM lineitem GROUP BY 1""")
def box_stats_lines(spark, sf):
    df = star.read(spark, sf, "lineitem").select("l_extendedprice", F.col("l_returnflag").alias("flag"))
    return settled(P.box_stats(df, "l_extendedprice", "flag").select("flag", "n", "q1", "median", "q3"), 4)


@query("sketched_box_lines", """
SELECT l_returnflag AS flag, count(l_extendedprice) AS n, min(l_extendedprice) AS low, max(l_extendedprice) AS high, CAST(0 AS BIGINT) AS quartiles_off
FROM lineitem GROUP BY 1""")
def sketched_box_lines(spark, sf):
    """Boxes from sketches of three stored batches; no quartile may miss its rank by more than three times the error stated at 99 % confidence."""
    lines = star.read(spark, sf, "lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_extendedprice").alias("price"), "l_linenumber")
    path = scratch_path(spark, "sketches")
    for b in range(3):
        partials.write_batch(sketches.states(lines.filter(F.col("l_linenumber") % 3 == b), ["flag"], ["price"]), path, str(b))
    found = sketches.boxes(sketches.merged(partials.read_batches(spark, path), ["flag"], ["price"]), ["flag"], ["price"])
    state = cut_lineage(found)
    off = sum(((F.col(q) > 3 * sketches.rank_error()).cast("long") for q in ("q1", "median", "q3")), F.lit(0).cast("long"))
    gaps = sketches.rank_gaps(lines, state, "flag", "price").select("flag", off.alias("quartiles_off"))
    return state.select("flag", "n", "low", "high").join(gaps, "flag")


@query("outlier_flag", _on("""
SELECT SK_ID_CURR, SEGMENT, BALANCE AS value, round(median, 5) AS median, CAST(BALANCE < "lower" OR BALANCE > "upper" AS INTEGER) AS is_outlier,
  CAST(BALANCE > median AS INTEGER) AS above_median FROM d JOIN b USING (SEGMENT)""", b=_BOX))
def outlier_flag(spark, sf):
    df = decided(spark, sf)
    return settled(P.outlier_flags(df, P.box_stats(df, "BALANCE", "SEGMENT"), "SK_ID_CURR", "BALANCE", "SEGMENT"), 5)


@query("mean_position", _on("""
SELECT SK_ID_CURR, BALANCE AS value, round((SELECT avg(BALANCE) FROM d), 6) AS mean_value, CAST(BALANCE > (SELECT avg(BALANCE) FROM d) AS INTEGER) AS above_mean FROM d"""))
def mean_position(spark, sf):
    return settled(P.mean_position(decided(spark, sf), "SK_ID_CURR", "BALANCE"))


FILTERS = {"BALANCE": (0.0, 6000.0), "SEGMENT": ["BUILDING", "MACHINERY"], "NATION": (2, 20), "PREDICTION": [1]}
_F1, _F2 = "BALANCE BETWEEN 0 AND 6000", "SEGMENT IN ('BUILDING', 'MACHINERY')"
_F3, _F4 = "NATION BETWEEN 2 AND 20", "PREDICTION = 1"


@query("filter_steps", _on(" UNION ALL ".join(
    f"SELECT {i} AS step, '{name}' AS feature, count(*) AS n_rows FROM d WHERE {' AND '.join(['TRUE', *tests])}"
    for i, (name, tests) in enumerate([("", []), ("BALANCE", [_F1]), ("SEGMENT", [_F1, _F2]), ("NATION", [_F1, _F2, _F3]), ("PREDICTION", [_F1, _F2, _F3, _F4])]))))
def filter_steps(spark, sf):
    return P.filter_steps(decided(spark, sf), FILTERS)


@query("dynamic_filters", _on(f"SELECT SK_ID_CURR, BALANCE, SEGMENT, NATION, PREDICTION FROM d WHERE {_F1} AND {_F2} AND {_F3} AND {_F4}"))
def dynamic_filters(spark, sf):
    out, _ = P.chained_filter(decided(spark, sf), FILTERS)
    return out.select("SK_ID_CURR", "BALANCE", "SEGMENT", "NATION", "PREDICTION")


@query("filter_roles", _on("""
SELECT 'NATION' AS feature, CASE WHEN count(DISTINCT NATION) > 5 THEN 'numeric' ELSE 'categorical' END AS role FROM d
UNION ALL SELECT 'SEGMENT', CASE WHEN count(DISTINCT SEGMENT) > 5 THEN 'numeric' ELSE 'categorical' END FROM d
UNION ALL SELECT 'PROBA', CASE WHEN count(DISTINCT PROBA) > 5 THEN 'numeric' ELSE 'categorical' END FROM d"""))
def filter_roles(spark, sf):
    from creditloom.operators.profiling import column_roles

    return column_roles(decided(spark, sf), ["NATION", "SEGMENT", "PROBA"], limit=5)


@query("scatter_rows", V.using("scored pos", """
SELECT SK_ID_CURR, BALANCE, worst, PROBA, CAST(PROBA > 0.48 AS INTEGER) AS PREDICTION FROM scored
JOIN (SELECT SK_ID_CURR, max(SK_DPD) AS worst FROM pos GROUP BY 1) USING (SK_ID_CURR) WHERE worst IS NOT NULL"""))
def scatter_rows(spark, sf):
    worst = star.pos_cash(spark, sf).groupBy("SK_ID_CURR").agg(F.max("SK_DPD").alias("worst"))
    joined = decided(spark, sf).join(worst, "SK_ID_CURR", "left")
    return drop_incomplete(joined, ["BALANCE", "worst", "PROBA"]).select("SK_ID_CURR", "BALANCE", "worst", "PROBA", "PREDICTION")


@query("value_labels", _on("""
SELECT SK_ID_CURR, CASE PREDICTION WHEN 0 THEN 'Crédit Accordé' WHEN 1 THEN 'Crédit Refusé' END AS label FROM d"""))
def value_labels(spark, sf):
    return decided(spark, sf).select("SK_ID_CURR", P.value_labels(F.col("PREDICTION"), P.LABELS["PREDICTION"]).alias("label"))


def _fmt(x: str, d: int = 2) -> str:
    return f"printf('%.{d}f', {x})"


@query("decision_text", _on(f"""
SELECT SK_ID_CURR, CASE WHEN PROBA > 0.48 THEN
  'Le crédit est refusé pour le client ' || SK_ID_CURR || '.' || chr(10) || 'Le risque d''insolvabilité du client est de ' || {_fmt('PROBA')}
    || ', ce risque est supérieur au risque que la banque peut tolérer (0.48).'
ELSE 'Le crédit est accordé pour le client ' || SK_ID_CURR || '.' || chr(10) || 'Le risque d''insolvabilité du client est de ' || {_fmt('PROBA')}
    || ', ce risque est tolérable pour la banque qui accepte jusqu''à 0.48 de risque.' END AS text FROM d"""))
def decision_text(spark, sf):
    return N.decision_texts(decided(spark, sf), 0.48)


@query("mean_text", _on(f"""
SELECT SK_ID_CURR, 'La valeur de BALANCE pour le client ' || SK_ID_CURR || ' (' || {_fmt('BALANCE')} || ') est '
  || CASE WHEN BALANCE <= m THEN 'inférieure' ELSE 'supérieure' END || ' à la moyenne (' || {_fmt('m')} || ').' AS text
FROM d, (SELECT avg(BALANCE) AS m FROM d)"""))
def mean_text(spark, sf):
    at = P.mean_position(decided(spark, sf), "SK_ID_CURR", "BALANCE")
    return at.select("SK_ID_CURR", N.mean_text("BALANCE", F.col("SK_ID_CURR"), F.col("value"), F.col("mean_value")).alias("text"))


@query("box_text", _on(f"""
SELECT SK_ID_CURR, 'Le client ' || SK_ID_CURR || ' appartient à la catégorie ' || SEGMENT || ' de SEGMENT.' || chr(10) || 'Au sein de cette catégorie :' || chr(10)
  || chr(9) || 'la médiane de BALANCE est de ' || {_fmt('median')} || '.' || chr(10)
  || chr(9) || 'Le client ' || SK_ID_CURR || CASE WHEN BALANCE > median THEN ' se situe en dessus' ELSE ' se situe au dessous' END
  || ' de la médiane (BALANCE = ' || {_fmt('BALANCE')} || ').' || chr(10)
  || chr(9) || 'Le client ' || SK_ID_CURR || CASE WHEN BALANCE < "lower" OR BALANCE > "upper" THEN ' est atypique' ELSE ' n''est pas atypique' END
  || ' par rapport à la population pour la caractérisitique BALANCE.' AS text FROM d JOIN b USING (SEGMENT)""", b=_BOX))
def box_text(spark, sf):
    df = decided(spark, sf)
    at = P.outlier_flags(df, P.box_stats(df, "BALANCE", "SEGMENT"), "SK_ID_CURR", "BALANCE", "SEGMENT")
    return at.select("SK_ID_CURR", N.box_text("BALANCE", "SEGMENT", F.col("SK_ID_CURR"), F.col("value"), F.col("SEGMENT"),
                                              F.col("median"), F.col("is_outlier")).alias("text"))


@query("gauge_guide", _on(f"""
SELECT SK_ID_CURR, 'Le risque est la probabilité de non-remboursement : ' || {_fmt('PROBA')} || ', soit ' || {_fmt('PROBA * 100', 0)}
  || '% de chances. La banque accorde le prêt jusqu''à 0.48 et le refuse au-delà ; ce seuil est choisi pour perdre le moins d''argent possible.' AS text FROM d"""))
def gauge_guide(spark, sf):
    return decided(spark, sf).select("SK_ID_CURR", N.gauge_guide(F.col("PROBA"), F.lit(0.48)).alias("text"))
