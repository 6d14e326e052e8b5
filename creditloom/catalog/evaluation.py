"""Model-evaluation queries over the scored population."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditloom.catalog import views as V
from creditloom.catalog.registry import query, settled
from creditloom.functions import gain as G
from creditloom.operators import metrics as M
from creditloom.operators import models
from creditloom.operators.splitting import stratified_folds
from creditloom.sources import starschema as star

THRESHOLD = 0.48
_CELLS = """count(*) FILTER (WHERE TARGET = 0 AND NOT {p}) AS tn, count(*) FILTER (WHERE TARGET = 0 AND {p}) AS fp,
  count(*) FILTER (WHERE TARGET = 1 AND NOT {p}) AS fn, count(*) FILTER (WHERE TARGET = 1 AND {p}) AS tp"""
_COUNTS = f"SELECT fold, {_CELLS.format(p='(PROBA > 0.48)')} FROM folded GROUP BY fold"
_GAIN = "(CAST(tp + tn - fp - 10 * fn + 10 * (tp + fn) + (tn + fp) AS DOUBLE) / ((tp + fn) + (tn + fp) + 10 * (tp + fn) + (tn + fp)))"
_METRICS = f"""SELECT *, CAST(tp + tn AS DOUBLE) / (tn + fp + fn + tp) AS accuracy,
  CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0 END AS recall,
  CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0 END AS "precision",
  CASE WHEN tp > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0 END AS f1_score, {_GAIN} AS business_gain FROM counts"""
_PER_SCORE = """SELECT fold, PROBA AS threshold, count(*) FILTER (WHERE TARGET = 1) AS pos, count(*) FILTER (WHERE TARGET = 0) AS neg
FROM folded GROUP BY 1, 2"""
_TOTALS = """SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg, sum(pos) OVER (PARTITION BY fold) AS all_pos,
  sum(neg) OVER (PARTITION BY fold) AS all_neg FROM per_score WINDOW w AS (PARTITION BY fold ORDER BY threshold DESC)"""
_AUC = """SELECT a.fold, CAST(sum(CASE WHEN a.PROBA > b.PROBA THEN 1 WHEN a.PROBA = b.PROBA THEN 0.5 ELSE 0 END) AS DOUBLE) / count(*) AS auc
FROM folded a JOIN folded b ON a.fold = b.fold AND a.TARGET = 1 AND b.TARGET = 0 GROUP BY 1"""


def folded(spark, sf):
    return stratified_folds(star.scored_population(spark, sf), "SK_ID_CURR", "TARGET", 5)


def totals(spark, sf):
    return M.score_totals(folded(spark, sf), "TARGET", "PROBA", ["fold"])


@query("confusion", V.using("folded", _COUNTS))
def confusion(spark, sf):
    return M.confusion(folded(spark, sf), "TARGET", "PROBA", THRESHOLD, ["fold"])


@query("normalised_confusion", V.using("folded", """SELECT fold, round(tn / CAST(tn + fp AS DOUBLE), 6) AS tn_rate, round(fp / CAST(tn + fp AS DOUBLE), 6) AS fp_rate,
  round(fn / CAST(fn + tp AS DOUBLE), 6) AS fn_rate, round(tp / CAST(fn + tp AS DOUBLE), 6) AS tp_rate FROM counts""", counts=_COUNTS))
def normalised_confusion(spark, sf):
    return settled(M.normalised_confusion(confusion(spark, sf)))


@query("classification_metrics", V.using("folded", """SELECT fold, tn, fp, fn, tp, round(accuracy, 6) AS accuracy, round(recall, 6) AS recall,
  round("precision", 6) AS "precision", round(f1_score, 6) AS f1_score, round(business_gain, 6) AS business_gain FROM m""", counts=_COUNTS, m=_METRICS))
def classification_metrics(spark, sf):
    return settled(M.with_metrics(confusion(spark, sf)))


@query("business_gain", V.using("scored", """
SELECT round((CAST(5000 * (tp + tn) - 5000 * fp - 50000 * fn + 50000 * (tp + fn) + 5000 * (tn + fp) AS DOUBLE))
  / (5000 * (tn + fp + fn + tp) + 50000 * (tp + fn) + 5000 * (tn + fp)), 6) AS business_gain FROM counts""",
                                 counts=f"SELECT {_CELLS.format(p='(PROBA > 0.48)')} FROM scored"))
def business_gain(spark, sf):
    counts = M.confusion(star.scored_population(spark, sf), "TARGET", "PROBA", THRESHOLD)
    return settled(M.with_metrics(counts, G.MONEY_GAINS).select("business_gain"))


@query("train_test_metrics", V.using("scored", f"""
SELECT part, tn, fp, fn, tp, round(accuracy, 6) AS accuracy, round(recall, 6) AS recall, round("precision", 6) AS "precision",
  round(f1_score, 6) AS f1_score, round(business_gain, 6) AS business_gain, round(auc, 6) AS auc FROM m JOIN a USING (part)""",
    parts="""SELECT *, CASE WHEN row_number() OVER (PARTITION BY TARGET ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR)
  <= round(count(*) OVER (PARTITION BY TARGET) * 0.25) THEN 1 ELSE 0 END AS part FROM scored""",
    counts=f"SELECT part, {_CELLS.format(p='(PROBA > 0.48)')} FROM parts GROUP BY part", m=_METRICS,
    a=_AUC.replace("fold", "part").replace("parted", "parts")))
def train_test_metrics(spark, sf):
    from creditloom.operators.splitting import stratified_split

    parts = stratified_split(star.scored_population(spark, sf), "SK_ID_CURR", "TARGET", 0.25, into="part")
    return settled(M.evaluate(parts, "TARGET", "PROBA", THRESHOLD, ["part"]))


@query("cv_metrics", V.using("folded", """SELECT fold, tn, fp, fn, tp, round(accuracy, 6) AS accuracy, round(recall, 6) AS recall,
  round("precision", 6) AS "precision", round(f1_score, 6) AS f1_score, round(business_gain, 6) AS business_gain, round(auc, 6) AS auc
FROM m JOIN a USING (fold)""", counts=_COUNTS, m=_METRICS, a=_AUC))
def cv_metrics(spark, sf):
    return settled(M.evaluate(folded(spark, sf), "TARGET", "PROBA", THRESHOLD))


_SWEEP = f"SELECT fold, threshold, {_CELLS.format(p='(PROBA >= threshold)')} FROM folded, grid GROUP BY 1, 2"
_GRID = "SELECT CAST(i AS DOUBLE) * (CAST(0.98 AS DOUBLE) / 98) + CAST(0.01 AS DOUBLE) AS threshold FROM range(99) r(i)"
_SUMMARY = f"SELECT threshold, avg({_GAIN}) AS mean_gain, stddev_pop({_GAIN}) AS std_gain FROM counts GROUP BY threshold"


@query("threshold_sweep", V.using("folded", f"""SELECT fold, threshold, tn, fp, fn, tp, round({_GAIN}, 6) AS business_gain FROM counts""",
                                   grid=_GRID, counts=_SWEEP))
def threshold_sweep(spark, sf):
    out = M.threshold_sweep(folded(spark, sf), "TARGET", "PROBA", "fold")
    return out.withColumn("business_gain", F.round("business_gain", 6))


@query("sweep_summary", V.using("folded", """SELECT threshold, round(mean_gain, 6) AS mean_gain, round(std_gain, 6) AS std_gain,
  round(mean_gain + std_gain, 6) AS upper, round(mean_gain - std_gain, 6) AS lower FROM s""", grid=_GRID, counts=_SWEEP, s=_SUMMARY))
def sweep_summary(spark, sf):
    out = M.sweep_summary(M.threshold_sweep(folded(spark, sf), "TARGET", "PROBA", "fold"))
    return out.select("threshold", *[F.round(c, 6).alias(c) for c in ("mean_gain", "std_gain", "upper", "lower")])


@query("sweep_best", V.using("folded", """SELECT threshold AS best_threshold, round(mean_gain, 6) AS best_gain FROM s
ORDER BY mean_gain DESC, threshold LIMIT 1""", grid=_GRID, counts=_SWEEP, s=_SUMMARY))
def sweep_best(spark, sf):
    out = M.best_gain(M.sweep_summary(M.threshold_sweep(folded(spark, sf), "TARGET", "PROBA", "fold")))
    return out.select("best_threshold", F.round("best_gain", 6).alias("best_gain"))


@query("roc_points", V.using("folded", """SELECT fold, threshold, round(CAST(cum_neg AS DOUBLE) / all_neg, 6) AS fpr,
  round(CAST(cum_pos AS DOUBLE) / all_pos, 6) AS tpr FROM totals""", per_score=_PER_SCORE, totals=_TOTALS))
def roc_points(spark, sf):
    return settled(M.roc_points(totals(spark, sf), ["fold"]))


@query("roc_auc", V.using("folded", "SELECT fold, round(auc, 6) AS auc FROM a", a=_AUC))
def roc_auc(spark, sf):
    return settled(M.roc_auc(totals(spark, sf), ["fold"]))


_CURVE = """
SELECT g.k AS step, g.fold, CASE WHEN g.k = 0 THEN 0 ELSE
  coalesce(lo.y + (g.k / CAST(99 AS DOUBLE) - lo.x) * (hi.y - lo.y) / nullif(hi.x - lo.x, 0), lo.y) END AS tpr
FROM (SELECT k, fold FROM range(100) r(k), (SELECT DISTINCT fold FROM points)) g
JOIN LATERAL (SELECT x, y, c FROM points p WHERE p.fold = g.fold AND p.c * 99 <= g.k * p.n ORDER BY c DESC, y DESC LIMIT 1) lo ON TRUE
LEFT JOIN LATERAL (SELECT x, y FROM points p WHERE p.fold = g.fold AND p.c * 99 > g.k * p.n ORDER BY c, y LIMIT 1) hi ON TRUE"""
_POINTS = """
SELECT fold, cum_neg AS c, all_neg AS n, CAST(cum_neg AS DOUBLE) / all_neg AS x, CAST(cum_pos AS DOUBLE) / all_pos AS y FROM totals
UNION ALL SELECT DISTINCT fold, 0, all_neg, 0.0::DOUBLE, 0.0::DOUBLE FROM totals"""
_MEAN_CURVE = "SELECT step, avg(tpr) AS mean_tpr, stddev_pop(tpr) AS std_tpr FROM curve GROUP BY step"


@query("mean_roc", V.using("folded", """SELECT CAST(step AS INTEGER) AS step, round(step / CAST(99 AS DOUBLE), 6) AS fpr, round(mean_tpr, 6) AS mean_tpr,
  round(std_tpr, 6) AS std_tpr, round(least(mean_tpr + std_tpr, 1), 6) AS tpr_upper, round(greatest(mean_tpr - std_tpr, 0), 6) AS tpr_lower FROM mean""",
                            per_score=_PER_SCORE, totals=_TOTALS, points=_POINTS, curve=_CURVE, mean=_MEAN_CURVE))
def mean_roc(spark, sf):
    return settled(M.mean_roc(M.roc_on_grid(totals(spark, sf), ["fold"])))


@query("mean_roc_auc", V.using("folded", """
SELECT round(sum((next_fpr - step / CAST(99 AS DOUBLE)) * (mean_tpr + next_tpr) / 2), 6) AS mean_auc FROM (
SELECT step, mean_tpr, lead(step / CAST(99 AS DOUBLE)) OVER (ORDER BY step) AS next_fpr, lead(mean_tpr) OVER (ORDER BY step) AS next_tpr FROM mean)""",
                                per_score=_PER_SCORE, totals=_TOTALS, points=_POINTS, curve=_CURVE, mean=_MEAN_CURVE))
def mean_roc_auc(spark, sf):
    return settled(M.mean_roc_auc(M.mean_roc(M.roc_on_grid(totals(spark, sf), ["fold"]))))


@query("pr_curve", V.using("folded", """SELECT fold, threshold, round(CAST(cum_pos AS DOUBLE) / (cum_pos + cum_neg), 6) AS "precision",
  round(CAST(cum_pos AS DOUBLE) / all_pos, 6) AS recall FROM totals""", per_score=_PER_SCORE, totals=_TOTALS))
def pr_curve(spark, sf):
    return settled(M.precision_recall(totals(spark, sf), ["fold"]))


@query("best_youden", V.using("folded", """
SELECT fold, threshold AS best_threshold, round(gap, 6) AS best_gap FROM (
SELECT *, CAST(cum_pos AS DOUBLE) / all_pos - CAST(cum_neg AS DOUBLE) / all_neg AS gap FROM totals)
QUALIFY row_number() OVER (PARTITION BY fold ORDER BY gap DESC, threshold DESC) = 1""", per_score=_PER_SCORE, totals=_TOTALS))
def best_youden(spark, sf):
    return settled(M.best_threshold(M.roc_points(totals(spark, sf), ["fold"]), ["fold"]))


_SUMMED = " UNION ALL ".join(
    f"SELECT '{c}' AS metric, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM m"
    for c in ("accuracy", "recall", "f1_score", "business_gain", "tn", "fp", "fn", "tp"))


@query("fold_summary", V.using("folded", _SUMMED, counts=_COUNTS, m=_METRICS))
def fold_summary(spark, sf):
    scores = M.with_metrics(confusion(spark, sf))
    return settled(M.fold_summary(scores, ["accuracy", "recall", "f1_score", "business_gain", "tn", "fp", "fn", "tp"]))


@query("class_weights", V.using("scored", """
SELECT TARGET, round(CAST((SELECT count(*) FROM scored) AS DOUBLE) / (2 * count(*)), 6) AS weight FROM scored GROUP BY TARGET"""))
def class_weights(spark, sf):
    return settled(models.class_weights(star.scored_population(spark, sf), "TARGET"))


@query("majority_baseline", V.using("scored", f"""
SELECT {_CELLS.format(p='(PRED = 1)')} FROM (SELECT TARGET, (SELECT mode(TARGET) FROM scored) AS PRED FROM scored)"""))
def majority_baseline(spark, sf):
    base = models.majority_baseline(star.scored_population(spark, sf), "TARGET")
    return M.confusion(base, "TARGET", "PROBA", 0.5)
