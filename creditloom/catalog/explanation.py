"""Importance, contribution and collinearity queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog import views as V
from creditloom.catalog.registry import query, settled
from creditloom.operators import collinearity as K
from creditloom.operators import explain as E
from creditloom.operators import importance as I
from creditloom.operators import models
from creditloom.operators import narrative as N
from creditloom.operators.profiling import missing_pct
from creditloom.operators.splitting import stratified_folds
from creditloom.sources import starschema as star

FEATURES = ["BALANCE", "NATION", "N_CREDITS", "DEBT", "DAYS"]
# A linear model as read from storage: coefficient per feature, intercept.
COEFFICIENTS = {"BALANCE": -0.00065, "NATION": 0.011, "N_CREDITS": 0.07, "DEBT": 0.0000004, "DAYS": -0.0009}
INTERCEPT = -0.4

_TABLE = """
SELECT s.SK_ID_CURR, s.TARGET, s.PROBA, s.BALANCE, CAST(s.NATION AS DOUBLE) AS NATION, CAST(coalesce(b.n, 0) AS DOUBLE) AS N_CREDITS,
  coalesce(b.debt, 0) AS DEBT, coalesce(b.days, 0) AS DAYS
FROM scored s LEFT JOIN (SELECT SK_ID_CURR, count(*) AS n, sum(AMT_CREDIT_SUM_DEBT) AS debt, avg(DAYS_CREDIT) AS days FROM bureau GROUP BY 1) b
USING (SK_ID_CURR)"""


def table(spark, sf):
    """Score, target and five complete features per client."""
    credits = star.bureau(spark, sf).groupBy("SK_ID_CURR").agg(
        F.count(F.lit(1)).cast("double").alias("N_CREDITS"), F.sum("AMT_CREDIT_SUM_DEBT").alias("DEBT"), F.avg("DAYS_CREDIT").alias("DAYS"))
    base = star.scored_population(spark, sf).select("SK_ID_CURR", "TARGET", "PROBA", "BALANCE", F.col("NATION").cast("double").alias("NATION"))
    return base.join(credits, "SK_ID_CURR", "left").fillna(0.0, ["N_CREDITS", "DEBT", "DAYS"])


def _on(body: str, **extra: str) -> str:
    return V.using("scored bureau", body, t=_TABLE, **extra)


# Per-fold importance: absolute correlation with the target, one aggregate per fold.
_FOLDED = """SELECT *, (row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR) - 1) % 5 AS fold FROM t"""
_PER_FOLD = " UNION ALL ".join(f"SELECT '{f}' AS feature, fold, abs(corr({f}, CAST(TARGET AS DOUBLE))) AS importance FROM f GROUP BY fold" for f in FEATURES)
_MISSING = " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {text} AS missing_pct FROM nt" for f, text in
    [(f, f"100 * (count(*) - count({f})) / CAST(count(*) AS DOUBLE)") for f in FEATURES])
_NULLED = "SELECT nullif(NATION, 3) AS NATION, CASE WHEN DEBT > 500000 THEN DEBT END AS DEBT, BALANCE, N_CREDITS, DAYS FROM t"
_RANKED = """SELECT feature, avg(importance) AS importance_mean, stddev_samp(importance) AS importance_std,
  row_number() OVER (ORDER BY avg(importance) DESC, feature) AS rank_importance, any_value(missing_pct) AS missing_pct FROM p JOIN m USING (feature) GROUP BY feature"""


def per_fold_importance(spark, sf):
    folds = stratified_folds(table(spark, sf), "SK_ID_CURR", "TARGET", 5)
    wide = folds.groupBy("fold").agg(*[F.abs(F.corr(f, F.col("TARGET").cast("double"))).alias(f) for f in FEATURES])
    return wide.unpivot(["fold"], FEATURES, "feature", "importance")


def importance_table(spark, sf):
    nulled = table(spark, sf).select(F.nullif("NATION", F.lit(3.0)).alias("NATION"), F.when(F.col("DEBT") > 500000, F.col("DEBT")).alias("DEBT"),
                                     "BALANCE", "N_CREDITS", "DAYS")
    ranked = I.ranked(I.fold_importance(per_fold_importance(spark, sf)))
    return I.with_missing(ranked, missing_pct(nulled, FEATURES))


@query("importance_folds", _on("SELECT feature, fold, round(importance, 6) AS importance FROM p", f=_FOLDED, p=_PER_FOLD))
def importance_folds(spark, sf):
    df = per_fold_importance(spark, sf)
    parts = [df.filter(F.col("fold") == i) for i in range(5)]
    return settled(I.stack(parts).withColumn("fold", F.col("fold").cast("bigint")))


@query("importance_rank", _on("""
SELECT feature, round(importance_mean, 6) AS importance_mean, round(importance_std, 6) AS importance_std, rank_importance, round(missing_pct, 6) AS missing_pct FROM r""",
                              f=_FOLDED, p=_PER_FOLD, nt=_NULLED, m=_MISSING, r=_RANKED))
def importance_rank(spark, sf):
    return settled(importance_table(spark, sf))


@query("importance_screen", _on("SELECT feature, rank_importance FROM r WHERE rank_importance >= 3 AND missing_pct > 30",
                                f=_FOLDED, p=_PER_FOLD, nt=_NULLED, m=_MISSING, r=_RANKED))
def importance_screen(spark, sf):
    return I.screened_out(importance_table(spark, sf), min_rank=3).select("feature", "rank_importance")


@query("topn_importance", _on("SELECT feature, round(importance_mean, 6) AS importance_mean FROM r ORDER BY importance_mean DESC, feature LIMIT 3",
                              f=_FOLDED, p=_PER_FOLD, nt=_NULLED, m=_MISSING, r=_RANKED))
def topn_importance(spark, sf):
    return settled(I.top(importance_table(spark, sf), 3, "importance_mean", sort_by_name=True).select("feature", "importance_mean"))


@query("topk_others", _on("""
SELECT CASE WHEN rank_importance <= 2 THEN feature ELSE 'Somme des Autres caractéristiques' END AS feature, round(sum(importance_mean), 6) AS importance_mean
FROM r GROUP BY 1""", f=_FOLDED, p=_PER_FOLD, nt=_NULLED, m=_MISSING, r=_RANKED))
def topk_others(spark, sf):
    return settled(I.top_with_others(importance_table(spark, sf), 2, "importance_mean"))


_C = "CAST({0!r} AS DOUBLE)"
_PHI = "SELECT SK_ID_CURR, PROBA, {}, {} AS output FROM t".format(
    ", ".join(f"{_C.format(b)} * ({f} - (SELECT avg({f}) FROM t)) AS {f}" for f, b in COEFFICIENTS.items()),
    f"{_C.format(INTERCEPT)} + " + " + ".join(f"{_C.format(b)} * {f}" for f, b in COEFFICIENTS.items()))
_BASE = f"{_C.format(INTERCEPT)} + " + " + ".join(f"{_C.format(b)} * (SELECT avg({f}) FROM t)" for f, b in COEFFICIENTS.items())
_LONG = " UNION ALL ".join(f"SELECT SK_ID_CURR, '{f}' AS feature, {f} AS contribution FROM phi" for f in FEATURES)
_PLACED = "SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY abs(contribution) DESC, feature) AS rank FROM long"
_GLOBAL = "SELECT feature, avg(abs(contribution)) AS importance, avg(contribution) AS signed_mean FROM long GROUP BY feature"


def contributions(spark, sf):
    df = table(spark, sf)
    output = F.lit(INTERCEPT)
    for f, b in COEFFICIENTS.items():
        output = output + F.lit(b) * F.col(f)
    means = E.feature_means(df, FEATURES)
    base = INTERCEPT + sum(b * means[f] for f, b in COEFFICIENTS.items())
    return E.linear_contributions(df.withColumn("output", output), COEFFICIENTS, means, ["SK_ID_CURR", "PROBA", "output"]), base


@query("linear_contrib", _on("SELECT SK_ID_CURR, " + ", ".join(f"round({f}, 6) AS {f}" for f in FEATURES) + " FROM phi", phi=_PHI))
def linear_contrib(spark, sf):
    return settled(contributions(spark, sf)[0].select("SK_ID_CURR", *FEATURES))


@query("additivity_check", _on(f"""
SELECT count(*) AS n, round(max(abs({_BASE} + {' + '.join(FEATURES)} - output)), 6) AS max_residual,
  round(avg(abs({_BASE} + {' + '.join(FEATURES)} - output)), 6) AS mean_residual FROM phi""", phi=_PHI))
def additivity_check(spark, sf):
    phi, base = contributions(spark, sf)
    return settled(E.additivity(phi, FEATURES, F.lit(base), "output"))


@query("local_topk", _on("""
SELECT SK_ID_CURR, CAST(rank AS INTEGER) AS rank, feature, round(contribution, 6) AS contribution, CASE WHEN contribution > 0 THEN 'risk' ELSE 'safe' END AS direction
FROM placed WHERE rank <= 3""", phi=_PHI, long=_LONG, placed=_PLACED))
def local_topk(spark, sf):
    return settled(E.local_top(contributions(spark, sf)[0], FEATURES, 3))


@query("global_importance", _on("""
SELECT feature, round(importance, 6) AS importance, round(signed_mean, 6) + 0 AS signed_mean,
  CASE WHEN round(signed_mean, 6) > 0 THEN 'Tire vers le REFUS du prêt' ELSE 'Tire vers l''ACCORD du prêt' END AS impact_direction FROM g""",
                                phi=_PHI, long=_LONG, g=_GLOBAL))
def global_importance(spark, sf):
    # Centred contributions have mean 0 up to rounding; settle before taking the sign.
    found = settled(E.global_importance(contributions(spark, sf)[0], FEATURES)).withColumn("signed_mean", F.col("signed_mean") + 0.0)
    return I.with_direction(found)


@query("signed_importance", _on("""
SELECT feature, round(avg(abs(c)), 6) AS importance, round(avg(c), 6) AS signed_mean,
  CASE WHEN avg(c) > 0 THEN 'Tire vers le REFUS du prêt' ELSE 'Tire vers l''ACCORD du prêt' END AS impact_direction
FROM (SELECT feature, contribution AS c FROM long JOIN scored USING (SK_ID_CURR) WHERE TARGET = 1) GROUP BY feature""", phi=_PHI, long=_LONG))
def signed_importance(spark, sf):
    defaults = star.scored_population(spark, sf).filter("TARGET = 1").select("SK_ID_CURR")
    phi = contributions(spark, sf)[0].join(defaults, "SK_ID_CURR", "left_semi")
    return settled(I.with_direction(E.global_importance(phi, FEATURES)))


@query("main_features", _on("""
SELECT SK_ID_CURR, CAST(row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY feature) - 1 AS INTEGER) AS pos, feature FROM (
  SELECT SK_ID_CURR, feature FROM placed WHERE rank <= 2
  UNION SELECT SK_ID_CURR, feature FROM phi, (SELECT feature FROM g ORDER BY importance DESC, feature LIMIT 2)
  UNION SELECT SK_ID_CURR, 'PROBA' FROM phi UNION SELECT SK_ID_CURR, 'PREDICTION' FROM phi)""", phi=_PHI, long=_LONG, placed=_PLACED, g=_GLOBAL))
def main_features(spark, sf):
    phi, _ = contributions(spark, sf)
    best = [r["feature"] for r in I.top(E.global_importance(phi, FEATURES), 2).collect()]
    return E.main_features(phi, FEATURES, best, 2)


@query("influence_text", _on(f"""
SELECT SK_ID_CURR, 'Les 3 caractéristiques qui impactent le plus la décision pour le client sont :' || chr(10)
  || string_agg(feature || chr(9) || 'Influence (' || printf('%.2f', contribution) || ') vers ' || CASE WHEN contribution > 0 THEN 'le REFUS' ELSE 'l''ACCORD' END
       || ' du prêt' || chr(10), '' ORDER BY rank)
  || chr(10) || 'La valeur de base (sans connaissance du client) est de ' || printf('%.3f', {_BASE}) || chr(10)
  || 'La prédiction du risque d''insolvabilité pour ce client (connaissant ses informations) est de ' || printf('%.3f', any_value(PROBA)) || '.' AS text
FROM placed JOIN scored USING (SK_ID_CURR) WHERE rank <= 3 GROUP BY SK_ID_CURR""", phi=_PHI, long=_LONG, placed=_PLACED))
def influence_text(spark, sf):
    phi, base = contributions(spark, sf)
    return phi.select("SK_ID_CURR", N.influence_text(E.contribution_list(FEATURES), 3, F.lit(base), F.col("PROBA")).alias("text"))


def _short(number: str) -> str:
    return f"regexp_replace(regexp_replace(printf('%.3f', {number}), '0+$', ''), '\\.$', '')"


_VALUE = "CASE feature " + " ".join(f"WHEN '{f}' THEN {f}" for f in FEATURES) + " END"


@query("reading_guide", _on(f"""
SELECT SK_ID_CURR, 'Sans rien savoir du client ' || SK_ID_CURR || ', le risque moyen E[f(X)] vaut ' || printf('%.3f', {_BASE})
  || '. Connaissant ses informations, le modèle prédit f(x)=' || {_short('t.PROBA')} || '. Le client a pour ' || feature || ' la valeur '
  || {_short(_VALUE)} || CASE WHEN contribution > 0 THEN '. Elle augmente son risque de ' || printf('%.2f', contribution) || ' et pousse vers un refus.'
       ELSE '. Elle change son risque de ' || printf('%.2f', contribution) || ' et pousse vers un accord.' END
  || ' La valeur de base plus toutes les influences donne le risque prédit.' AS text
FROM placed JOIN t USING (SK_ID_CURR) WHERE rank = 1""", phi=_PHI, long=_LONG, placed=_PLACED))
def reading_guide(spark, sf):
    phi, base = contributions(spark, sf)
    first = phi.select("SK_ID_CURR", "PROBA", F.element_at(E.contribution_list(FEATURES), 1).alias("c"))
    values = table(spark, sf).select("SK_ID_CURR", F.create_map(*[x for f in FEATURES for x in (F.lit(f), F.col(f))]).alias("v"))
    return first.join(values, "SK_ID_CURR").select("SK_ID_CURR", N.reading_guide(
        F.col("SK_ID_CURR"), F.lit(base), F.col("PROBA"), F.col("c.feature"), F.try_element_at("v", F.col("c.feature")),
        F.col("c.contribution")).alias("text"))


def _game(members: str) -> str:
    """Logistic output with the absent players at their mean."""
    parts = [f"{_C.format(COEFFICIENTS[f])} * {f if f in members.split() else f'm_{f}'}" for f in ("BALANCE", "NATION", "N_CREDITS")]
    return f"1 / (1 + exp(-({_C.format(INTERCEPT)} + {' + '.join(parts)})))"


_G = {name: _game(m) for name, m in {
    "e": "", "b": "BALANCE", "n": "NATION", "c": "N_CREDITS", "bn": "BALANCE NATION", "bc": "BALANCE N_CREDITS", "nc": "NATION N_CREDITS",
    "bnc": "BALANCE NATION N_CREDITS"}.items()}


@query("exact_shapley", _on("""
SELECT SK_ID_CURR, round(e, 6) AS base_value, round((b - e) / 3 + (bn - n) / 6 + (bc - c) / 6 + (bnc - nc) / 3, 6) AS BALANCE,
  round((n - e) / 3 + (bn - b) / 6 + (nc - c) / 6 + (bnc - bc) / 3, 6) AS NATION,
  round((c - e) / 3 + (bc - b) / 6 + (nc - n) / 6 + (bnc - bn) / 3, 6) AS N_CREDITS, round(bnc, 6) AS output FROM v""",
    mm="SELECT avg(BALANCE) AS m_BALANCE, avg(NATION) AS m_NATION, avg(N_CREDITS) AS m_N_CREDITS FROM t",
    v="SELECT SK_ID_CURR, " + ", ".join(f"{text} AS {n}" for n, text in _G.items()) + " FROM t, mm"))
def exact_shapley(spark, sf):
    df = table(spark, sf)
    players = ["BALANCE", "NATION", "N_CREDITS"]
    means = E.feature_means(df, players)

    def value(known):
        score = F.lit(INTERCEPT)
        for p in players:
            score = score + F.lit(COEFFICIENTS[p]) * (F.col(p) if p in known else F.lit(means[p]))
        return 1 / (1 + F.exp(-score))

    return settled(E.exact_shapley(df, players, value))


_UNIT = "(CAST('0x' || substr(draw, 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE))"
_PLAYERS = {"BALANCE": "h0", "NATION": "h1", "N_CREDITS": "h2"}


def _walk(player: str, gained: bool) -> str:
    """Output of the logistic model when the players drawn before `player`, and it too if `gained`, are known."""
    parts = [f"{_C.format(COEFFICIENTS[f])} * " + ((f if gained else f"r_{f}") if f == player else f"CASE WHEN {h} < {_PLAYERS[player]} THEN {f} ELSE r_{f} END")
             for f, h in _PLAYERS.items()]
    return f"1 / (1 + exp(-({_C.format(INTERCEPT)} + {' + '.join(parts)})))"


@query("shapley_sample", _on("""
SELECT SK_ID_CURR, feature, round(avg(d), 6) AS contribution, round(stddev_samp(d) / sqrt(8), 6) AS std_error FROM steps GROUP BY 1, 2""",
    bg="SELECT BALANCE AS r_BALANCE, NATION AS r_NATION, N_CREDITS AS r_N_CREDITS, "
       "row_number() OVER (ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR) AS place FROM t QUALIFY place <= 50",
    draws="SELECT *, md5(SK_ID_CURR || '-42-' || perm) AS draw FROM t, range(1, 9) r(perm)",
    walks=f"SELECT *, md5(draw || '-0') AS h0, md5(draw || '-1') AS h1, md5(draw || '-2') AS h2 FROM draws JOIN bg "
          f"ON place = CAST(floor({_UNIT} * (SELECT count(*) FROM bg)) + 1 AS BIGINT)",
    steps=" UNION ALL ".join(f"SELECT SK_ID_CURR, '{f}' AS feature, {_walk(f, True)} - {_walk(f, False)} AS d FROM walks" for f in _PLAYERS)))
def shapley_sample(spark, sf):
    df = table(spark, sf)
    players = ["BALANCE", "NATION", "N_CREDITS"]

    def predict(frame):
        score = F.lit(INTERCEPT)
        for p in players:
            score = score + F.lit(COEFFICIENTS[p]) * F.col(p)
        return frame.withColumn("PROBA", 1 / (1 + F.exp(-score)))

    return settled(E.sampled_shapley(df, players, E.background_rows(df, players), predict))


@query("impute_scale", _on("""
SELECT SK_ID_CURR, round((coalesce(DEBT, md) - md) / sqrt(sum(power(coalesce(DEBT, md) - md, 2)) OVER () / count(*) OVER ()), 6) + 0 AS DEBT,
  round((NATION - mn) / sqrt(sum(power(NATION - mn, 2)) OVER () / count(*) OVER ()), 6) + 0 AS NATION, CAST(0 AS DOUBLE) AS ONE
FROM (SELECT SK_ID_CURR, NATION, avg(NATION) OVER () AS mn, DEBT, avg(DEBT) OVER () AS md FROM (
  SELECT SK_ID_CURR, NATION, CASE WHEN DEBT > 500000 THEN DEBT END AS DEBT FROM t))"""))
def impute_scale(spark, sf):
    df = table(spark, sf).select("SK_ID_CURR", "NATION", F.when(F.col("DEBT") > 500000, F.col("DEBT")).alias("DEBT"), F.lit(1.0).alias("ONE"))
    out = models.ImputeScale(["DEBT", "NATION", "ONE"]).fit(df).transform(df)
    return settled(out).select("SK_ID_CURR", *[(F.col(c) + 0.0).alias(c) for c in ("DEBT", "NATION", "ONE")])


@query("vif_pair", _on(" UNION ALL ".join(
    f"SELECT '{f}' AS feature, round(1 / (1 - power(corr(DEBT, N_CREDITS), 2)), 6) AS vif FROM t" for f in ("DEBT", "N_CREDITS"))))
def vif_pair(spark, sf):
    return settled(K.vif_table(table(spark, sf), ["DEBT", "N_CREDITS"]))



@query("vif_triple", _on(" UNION ALL ".join(
    f"""SELECT '{f}' AS feature, round((1 - power({other}, 2)) / (1 + 2 * dn * db * nb - power(dn, 2) - power(db, 2) - power(nb, 2)), 6) AS vif,
  CASE WHEN (1 - power({other}, 2)) / (1 + 2 * dn * db * nb - power(dn, 2) - power(db, 2) - power(nb, 2)) < 5 THEN 'low' ELSE 'watch' END AS band FROM r"""
    for f, other in (("DEBT", "nb"), ("N_CREDITS", "db"), ("BALANCE", "dn"))),
    r="SELECT corr(DEBT, N_CREDITS) AS dn, corr(DEBT, BALANCE) AS db, corr(N_CREDITS, BALANCE) AS nb FROM t"))
def vif_triple(spark, sf):
    out = settled(K.vif_table(table(spark, sf), ["DEBT", "N_CREDITS", "BALANCE"]))
    return out.withColumn("band", K.vif_band(F.col("vif")))


@query("vif_selected", _on("SELECT SK_ID_CURR, BALANCE FROM t"))
def vif_selected(spark, sf):
    # Two columns that are linear in one another: the selector keeps one of each such pair.
    df = table(spark, sf).select("SK_ID_CURR", "BALANCE", (F.col("BALANCE") * 2 + 1).alias("TWICE"))
    model = K.VifSelector(["TWICE", "BALANCE"]).fit(df)
    assert len(model.removed) == 1, model.removed
    kept = model.transform(df)
    return kept.select("SK_ID_CURR", (F.col("BALANCE") if "BALANCE" in kept.columns else (F.col("TWICE") - 1) / 2).alias("BALANCE"))
