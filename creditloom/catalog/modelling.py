"""Queries that fit, score, resample and select."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from creditloom.catalog import views as V
from creditloom.catalog.evaluation import _COUNTS, _METRICS, _AUC, cv_metrics
from creditloom.catalog.explanation import FEATURES, _TABLE, table
from creditloom.catalog.registry import query, settled
from creditloom.functions import gain as G
from creditloom.operators import importance as I
from creditloom.operators import metrics as M
from creditloom.operators import models as L
from creditloom.operators import runs as R
from creditloom.operators import selection as S
from creditloom.operators.boosting import routed_trees
from creditloom.operators.encoding import category_dictionary
from creditloom.operators.neighbours import nearest_neighbours
from creditloom.operators.profiling import missing_pct
from creditloom.operators.resampling import smote, synthetic_minority
from creditloom.operators.search import Study
from creditloom.operators.splitting import stratified_folds
from creditloom.session import scratch_path
from creditloom.sources import starschema as star
from creditloom.streaming import scoring

# The target is the sign of BALANCE, so fitted models see the other features and a noisy score.
INPUTS = ["NATION", "N_CREDITS", "DEBT", "DAYS", "PROBA"]


def training(spark, sf):
    return stratified_folds(table(spark, sf), "SK_ID_CURR", "TARGET", 5)


def _logistic(features):
    return L.logistic(features, weight="weight", max_iter=20)


@query("cv_logreg")
def cv_logreg(spark, sf):
    df = L.with_balanced_weight(training(spark, sf), "TARGET")
    cv = L.cross_validate(df, INPUTS, "TARGET", "fold", 5, _logistic, extra=["weight"])
    return cv.metrics("TARGET")


@query("cv_trees")
def cv_trees(spark, sf):
    df = L.with_balanced_weight(training(spark, sf), "TARGET")
    cv = L.cross_validate(df, INPUTS, "TARGET", "fold", 5, lambda f: L.boosted_trees(f, weight="weight", max_iter=5, max_depth=3), extra=["weight"])
    return cv.metrics("TARGET")


@query("cv_smote")
def cv_smote(spark, sf):
    """Training folds rebalanced by synthetic rows; held-out rows stay as they are."""
    df = stratified_folds(_scaled(spark, sf).join(table(spark, sf).select("SK_ID_CURR", "PROBA"), "SK_ID_CURR"), "SK_ID_CURR", "TARGET", 3)
    inputs = ["X2", "X3", "PROBA"]
    cv = L.cross_validate(df, inputs, "TARGET", "fold", 3, lambda f: L.logistic(f, max_iter=20),
                          resample=lambda train: smote(train, inputs, "TARGET"))
    return cv.metrics("TARGET")


@query("cv_importance")
def cv_importance(spark, sf):
    df = training(spark, sf)
    cv = L.cross_validate(df, INPUTS, "TARGET", "fold", 5, lambda f: L.boosted_trees(f, max_iter=5, max_depth=3))
    ranked = I.ranked(I.fold_importance(cv.fold_importance))
    return I.with_missing(ranked, missing_pct(df, INPUTS))


@query("feature_elimination")
def feature_elimination(spark, sf):
    history = S.eliminate(training(spark, sf), INPUTS, "TARGET", "fold", 4, lambda f: L.logistic(f, max_iter=10), min_features=2, step=0.4)
    return S.history_view(history, 1, 100)


@query("feature_elbow")
def feature_elbow(spark, sf):
    return S.elbow(training(spark, sf), ["PROBA", "NATION", "N_CREDITS", "DEBT", "DAYS"], "TARGET", "fold", 3,
                   lambda f: L.logistic(f, max_iter=10), sizes=(5, 3, 1), threshold=0.2)


@query("parameter_search")
def parameter_search(spark, sf):
    """Six trials: random ones first, then by the density ratio."""
    df = L.with_balanced_weight(training(spark, sf), "TARGET")
    return S.model_search(df, INPUTS, "TARGET", "fold", 3, lambda f, p, share: L.logistic(f, weight="weight", c=p["c"], l1_ratio=p["l1_ratio"], max_iter=20),
                          Study(S.LOGISTIC_SPACE, startup=4), 6, extra=["weight"]).drop("state", "history")


@query("tree_search")
def tree_search(spark, sf):
    """Trees that route NULL, every parameter as drawn; a trial first runs a fifth of its rounds and goes on if it is among the better half."""
    return S.model_search(training(spark, sf), INPUTS, "TARGET", "fold", 3,
                          lambda f, p, share: routed_trees(f, {**p, "max_iter": max(1, round(share * p["max_iter"]))}), Study(S.TREE_SPACE, startup=3), 4, (0.2, 1.0), 2.0)


@query("fitted_sweep", V.using("folded", """
SELECT fold, CAST(99 AS BIGINT) AS n_thresholds, count(*) FILTER (WHERE TARGET = 0) AS negatives, count(*) FILTER (WHERE TARGET = 1) AS positives,
  CAST(0 AS BIGINT) AS falls FROM folded GROUP BY fold"""))
def fitted_sweep(spark, sf):
    """What every sweep must satisfy: all thresholds, all rows at each of them, and refusals that only fall as the threshold rises."""
    sweep = S.fitted_sweep(training(spark, sf), INPUTS, "TARGET", "fold", 5, lambda f: L.logistic(f, max_iter=10))
    before = Window.partitionBy("fold").orderBy("threshold")
    stepped = sweep.withColumn("fall", (F.col("tn") < F.lag("tn").over(before)) | (F.col("fn") < F.lag("fn").over(before)))
    return stepped.groupBy("fold").agg(
        F.count_distinct("threshold").alias("n_thresholds"), F.min(F.col("tn") + F.col("fp")).alias("negatives"),
        F.max(F.col("fn") + F.col("tp")).alias("positives"), F.count_if("fall").alias("falls"))


_LEFT_OUT = "CAST(sum(p) OVER (PARTITION BY {0}) - p AS DOUBLE) / (sum(n) OVER (PARTITION BY {0}) - n)"


def _flagged(spark, sf):
    """The population with a 0/1 column per segment but the first, and their names. A logistic model of them that is not penalised scores with class shares."""
    people = stratified_folds(star.scored_population(spark, sf), "SK_ID_CURR", "TARGET", 5)
    names = category_dictionary(people, ["SEGMENT"], nulls=False)["SEGMENT"]
    flags = {f"S{i}": (F.col("SEGMENT") == n).cast("double") for i, n in enumerate(names[1:], start=1)}
    return people.withColumns(flags), list(flags)


def _unpenalised(features):
    return L.logistic(features, c=1e9, max_iter=200, tol=1e-10)


_PLACED = "SELECT *, CAST(dense_rank() OVER (ORDER BY SEGMENT) - 1 AS INTEGER) AS i FROM folded"


@query("saturated_predict", V.using("scored", """
SELECT SK_ID_CURR, round(share, 4) AS PROBA, CAST(share > CAST(0.0901 AS DOUBLE) AS INTEGER) AS PREDICTION, CAST(0.0901 AS DOUBLE) AS THRESHOLD
FROM (SELECT SK_ID_CURR, avg(TARGET) OVER (PARTITION BY SEGMENT) AS share FROM scored)"""))
def saturated_predict(spark, sf):
    """Batch scores of a model whose scores are the class shares of the segments."""
    people, flags = _flagged(spark, sf)
    return settled(L.predict(_unpenalised(flags).fit(people), people, ["SK_ID_CURR"], threshold=0.0901), 4)


_LOSS = 0.002
_UNIT_GAIN = "avg(CAST(tp + tn - fp - 10 * fn + 10 * (tp + fn) + (tn + fp) AS DOUBLE) / (2 * (tn + fp) + 11 * (tp + fn)))"


def _cells(positives: str, rows: str) -> str:
    """Confusion counts of groups whose score is `share`."""
    hit, no = "share > CAST(0.0901 AS DOUBLE)", f"({rows} - ({positives}))"
    return ", ".join(f"sum(CASE WHEN {test} THEN {n} ELSE 0 END) AS {name}" for name, test, n in (
        ("tp", hit, positives), ("fp", hit, no), ("fn", f"NOT ({hit})", positives), ("tn", f"NOT ({hit})", no)))


@query("saturated_elbow", V.using("folded", f"""
SELECT CAST(size AS INTEGER) AS n_features, round(gain_train, 6) AS gain_train, round(gain_val, 6) AS gain_val FROM (
  SELECT *, count(*) FILTER (WHERE gain_val < best - {_LOSS}) OVER (ORDER BY size DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS fallen
  FROM (SELECT *, first_value(gain_val) OVER (ORDER BY size DESC) AS best FROM val JOIN train USING (size))) WHERE fallen = 0""",
    placed=_PLACED, c="SELECT size, fold, CASE WHEN i <= size THEN i ELSE 0 END AS g, count(*) AS n, sum(TARGET) AS p FROM placed, (SELECT unnest([4, 3, 2, 1]) AS size) GROUP BY 1, 2, 3",
    s=f"""SELECT *, sum(n) OVER (PARTITION BY size, g) - n AS tn_rows, sum(p) OVER (PARTITION BY size, g) - p AS tp_rows,
  {_LEFT_OUT.format('size, g')} AS share FROM c""",
    val=f"SELECT size, {_UNIT_GAIN} AS gain_val FROM (SELECT size, fold, {_cells('p', 'n')} FROM s GROUP BY 1, 2) GROUP BY 1",
    train=f"SELECT size, {_UNIT_GAIN} AS gain_train FROM (SELECT size, fold, {_cells('tp_rows', 'tn_rows')} FROM s GROUP BY 1, 2) GROUP BY 1"))
def saturated_elbow(spark, sf):
    """Fewer and fewer segments told apart; the scores are class shares, so that SQL knows every gain and where the search stops."""
    people, flags = _flagged(spark, sf)
    return settled(S.elbow(people, flags, "TARGET", "fold", 5, _unpenalised, sizes=(4, 3, 2, 1), loss=_LOSS, threshold=0.0901).drop("fit_ms"))


def _round_sql(r: int) -> dict[str, str]:
    """Views of one round of elimination: groups told apart by the flags left, scores, importances, the flag that goes, the AUC, the flags after it."""
    return {
        f"c{r}": f"SELECT fold, coalesce(l.i, 0) AS g, count(*) AS n, sum(TARGET) AS p FROM placed LEFT JOIN left{r} l USING (i) GROUP BY 1, 2",
        f"t{r}": f"""SELECT *, sum(n) OVER (PARTITION BY g) - n AS rows_in, sum(n) OVER () - sum(n) OVER (PARTITION BY fold) AS all_in,
  {_LEFT_OUT.format('g')} AS share FROM c{r}""",
        f"m{r}": f"""SELECT a.g AS i, avg(abs(ln(a.share / (1 - a.share)) - ln(b.share / (1 - b.share)))
  * sqrt(CAST(a.rows_in AS DOUBLE) / a.all_in * (1 - CAST(a.rows_in AS DOUBLE) / a.all_in))) AS importance
FROM t{r} a JOIN t{r} b ON a.fold = b.fold AND a.g > 0 AND b.g = 0 GROUP BY 1""",
        f"out{r}": f"SELECT i FROM m{r} WHERE (SELECT count(*) FROM m{r}) > 1 ORDER BY importance, i LIMIT 1",
        f"auc{r}": f"""SELECT avg(auc) AS auc FROM (SELECT a.fold, CAST(sum(a.p * (b.n - b.p) * CASE WHEN round(a.share, 6) > round(b.share, 6) THEN 1
  WHEN round(a.share, 6) = round(b.share, 6) THEN 0.5 ELSE 0 END) AS DOUBLE) / (sum(a.p * (b.n - b.p))) AS auc FROM t{r} a JOIN t{r} b ON a.fold = b.fold GROUP BY 1)""",
        f"left{r + 1}": f"SELECT i FROM left{r} WHERE i NOT IN (SELECT i FROM out{r})",
    }


@query("saturated_elimination", V.using("folded", " UNION ALL ".join(f"""
SELECT CAST({r} AS INTEGER) AS iteration, CAST((SELECT count(*) FROM left{r}) AS INTEGER) AS n_features, round((SELECT auc FROM auc{r}), 5) AS auc,
  (SELECT string_agg('S' || i, ',' ORDER BY i) FROM left{r}) AS features, coalesce((SELECT string_agg('S' || i, ',') FROM out{r}), '') AS removed""" for r in (1, 2, 3, 4)),
    placed=_PLACED, left1="SELECT DISTINCT i FROM placed WHERE i > 0", **{k: v for r in (1, 2, 3, 4) for k, v in _round_sql(r).items()}))
def saturated_elimination(spark, sf):
    """Recursive elimination one by one. Coefficients of the saturated model are differences of log odds, so that SQL knows the whole history."""
    people, flags = _flagged(spark, sf)
    history = S.eliminate(people, flags, "TARGET", "fold", 5, _unpenalised, min_features=1, step=1, score_digits=6)
    return settled(history.withColumns({c: F.array_join(c, ",") for c in ("features", "removed")}), 5)


@query("saturated_logistic", V.using("folded", f"""
SELECT fold, SEGMENT, n, round({_LEFT_OUT.format('SEGMENT')}, 4) AS proba FROM s""",
                                     s="SELECT fold, SEGMENT, count(*) AS n, sum(TARGET) AS p FROM folded GROUP BY 1, 2"))
def saturated_logistic(spark, sf):
    """A logistic model of one category, unpenalised, scores held-out rows with the share of its training folds."""
    people, flags = _flagged(spark, sf)
    cv = L.cross_validate(people, flags, "TARGET", "fold", 5, _unpenalised)
    return settled(cv.scores.join(people.select("SK_ID_CURR", "SEGMENT"), "SK_ID_CURR").groupBy("fold", "SEGMENT").agg(
        F.count(F.lit(1)).alias("n"), F.avg("PROBA").alias("proba")), 4)


@query("single_stump", V.using("folded", f"""
SELECT fold, flag, n, round(1 / (1 + exp(-2 * (2 * {_LEFT_OUT.format('flag')} - 1))), 6) AS proba FROM s""",
                               s="SELECT fold, CAST(PROBA > 0.48 AS INTEGER) AS flag, count(*) AS n, sum(TARGET) AS p FROM folded GROUP BY 1, 2"))
def single_stump(spark, sf):
    """One boosting round of depth 1 on a 0/1 column: each leaf holds the mean of its training labels, as -1 and 1."""
    people = stratified_folds(star.scored_population(spark, sf), "SK_ID_CURR", "TARGET", 5).withColumn("flag", (F.col("PROBA") > 0.48).cast("int"))
    cv = L.cross_validate(people, ["flag"], "TARGET", "fold", 5, lambda f: L.boosted_trees(f, max_iter=1, max_depth=1))
    return settled(cv.scores.join(people.select("SK_ID_CURR", "flag"), "SK_ID_CURR").groupBy("fold", "flag").agg(
        F.count(F.lit(1)).alias("n"), F.avg("PROBA").alias("proba")))


@query("best_trial")
def best_trial(spark, sf):
    return S.best_trial(parameter_search(spark, sf))


@query("batch_predict")
def batch_predict(spark, sf):
    df = table(spark, sf)
    model = L.logistic(INPUTS, max_iter=20).fit(df)
    return L.predict(model, df, ["SK_ID_CURR"], threshold=0.48)


def _scaled(spark, sf):
    return table(spark, sf).select("SK_ID_CURR", "TARGET", (F.col("BALANCE") / 1000).alias("X1"), (F.col("NATION") / 10).alias("X2"),
                                   (F.col("N_CREDITS") / 10).alias("X3"))


_SCALED = "SELECT SK_ID_CURR, TARGET, BALANCE / 1000 AS X1, NATION / 10 AS X2, N_CREDITS / 10 AS X3 FROM t"
_NEAR = """SELECT a.SK_ID_CURR, b.SK_ID_CURR AS neighbour, sqrt(power(a.X1 - b.X1, 2) + power(a.X2 - b.X2, 2) + power(a.X3 - b.X3, 2)) AS distance,
  b.X1 AS Y1, b.X2 AS Y2, b.X3 AS Y3, row_number() OVER (PARTITION BY a.SK_ID_CURR ORDER BY
    round(sqrt(power(a.X1 - b.X1, 2) + power(a.X2 - b.X2, 2) + power(a.X3 - b.X3, 2)), 12), b.SK_ID_CURR) AS place
FROM {0} a JOIN {0} b ON a.SK_ID_CURR <> b.SK_ID_CURR QUALIFY place <= 5"""
_MINORITY = "SELECT * FROM s WHERE TARGET = 1"


@query("nearest_neighbours", V.using("scored bureau", """
SELECT SK_ID_CURR, neighbour, round(distance, 6) AS distance, CAST(place AS INTEGER) AS place FROM near""",
                                     t=_TABLE, s=_SCALED, near=_NEAR.format("s")))
def neighbours(spark, sf):
    points = _scaled(spark, sf).select("SK_ID_CURR", F.array("X1", "X2", "X3").alias("vec"))
    return settled(nearest_neighbours(points, 5).drop("neighbour_vec"))


def _unit(text: str) -> str:
    return f"(CAST('0x' || substr({text}, 1, 8) AS BIGINT) / CAST(4294967296 AS DOUBLE))"


@query("smote_rows", V.using("scored bureau", f"""
SELECT SK_ID_CURR AS parent, neighbour, CAST(copy AS INTEGER) AS copy, CAST(1 AS INTEGER) AS TARGET, round(X1 + w * (Y1 - X1), 6) AS X1,
  round(X2 + w * (Y2 - X2), 6) AS X2, round(X3 + w * (Y3 - X3), 6) AS X3
FROM (SELECT c.*, {_unit('draw')} AS w, CAST(floor({_unit('md5(draw)')} * 5) + 1 AS BIGINT) AS pick FROM (
  SELECT r.*, copy, md5(SK_ID_CURR || '-42-' || copy) AS draw FROM ranked r, LATERAL (SELECT unnest(range(1, copies + 1)) AS copy)) c) d
JOIN near n USING (SK_ID_CURR) WHERE n.place = d.pick""", t=_TABLE, s=_SCALED, mi=_MINORITY, near=_NEAR.format("mi"), ranked="""
SELECT *, needed // n + CASE WHEN r <= needed % n THEN 1 ELSE 0 END AS copies FROM (
  SELECT *, row_number() OVER (ORDER BY md5(CAST(SK_ID_CURR AS VARCHAR) || '-42'), SK_ID_CURR) AS r, count(*) OVER () AS n,
    (SELECT count(*) FROM s WHERE TARGET = 0) - count(*) OVER () AS needed FROM mi)"""))
def smote_rows(spark, sf):
    return settled(synthetic_minority(_scaled(spark, sf), ["X1", "X2", "X3"], "TARGET"))


@query("smote_balance", V.using("scored", """
SELECT TARGET, CAST(synthetic AS INTEGER) AS synthetic, n FROM (
  SELECT TARGET, 0 AS synthetic, count(*) AS n FROM scored GROUP BY TARGET
  UNION ALL SELECT 1, 1, (SELECT count(*) FROM scored WHERE TARGET = 0) - (SELECT count(*) FROM scored WHERE TARGET = 1))"""))
def smote_balance(spark, sf):
    out = smote(_scaled(spark, sf), ["X1", "X2", "X3"], "TARGET")
    return out.groupBy("TARGET", "synthetic").agg(F.count(F.lit(1)).alias("n"))


_RECORD = f"""SELECT 'md5 score' AS "name", avg(auc) AS auc, avg(accuracy) AS accuracy, avg(recall) AS recall, avg(f1_score) AS f1_score,
  avg(business_gain) AS business_gain, avg(tn) AS tn, avg(fp) AS fp, avg(fn) AS fn, avg(tp) AS tp, (SELECT count(*) FROM scored) AS n_rows
FROM m JOIN a USING (fold)"""


def record(spark, sf, name, threshold):
    scores = M.fold_summary(cv_metrics(spark, sf), ["auc", "accuracy", "recall", "f1_score", "business_gain", "tn", "fp", "fn", "tp"])
    n_rows = star.scored_population(spark, sf).agg(F.count(F.lit(1))).scalar()
    return R.run_record(scores, {"name": name}, G.UNIT_GAINS, "Score", 1, n_rows, threshold, "none")


@query("run_record", V.using("folded", """
SELECT "name", round(auc, 5) AS auc, round(accuracy, 5) AS accuracy, round(recall, 5) AS recall, round(f1_score, 5) AS f1_score,
  round(business_gain, 5) AS business_gain, tn, fp, fn, tp, CAST(1 AS DOUBLE) AS gain_tp, CAST(1 AS DOUBLE) AS gain_tn, CAST(-1 AS DOUBLE) AS loss_fp,
  CAST(-10 AS DOUBLE) AS loss_fn, 'Score' AS model_name, CAST(1 AS INTEGER) AS n_feat, n_rows, CAST(0.48 AS DOUBLE) AS threshold, 'none' AS balancing FROM r""",
                             counts=_COUNTS, m=_METRICS, a=_AUC, r=_RECORD))
def run_record(spark, sf):
    return settled(record(spark, sf, "md5 score", 0.48), 5)


def _runs(spark, sf):
    """A small run table: one run per market segment."""
    counts = M.with_metrics(M.confusion(star.scored_population(spark, sf), "TARGET", "PROBA", 0.48, ["SEGMENT"]))
    place = F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy("SEGMENT")).cast("double")
    return counts.select(place.alias("position"), F.col("SEGMENT").alias("name"), "tp", "accuracy", "business_gain",
                         (F.col("tn") * 100.0).alias("fit_time"))


_RUNS = f"""SELECT CAST(dense_rank() OVER (ORDER BY SEGMENT) AS DOUBLE) AS position, SEGMENT AS "name", tp, accuracy, business_gain,
  CAST(tn AS DOUBLE) * 100 AS fit_time FROM m"""
_SEGMENT_COUNTS = _COUNTS.replace("fold,", "SEGMENT,").replace("GROUP BY fold", "GROUP BY SEGMENT").replace("FROM folded", "FROM scored")


@query("run_table", V.using("scored", """
SELECT "name", CAST(tp AS BIGINT) AS tp, printf('%.4f', accuracy) AS accuracy, printf('%.2f', business_gain) AS business_gain,
  printf('%d:%02d:%02d', CAST(fit_time AS BIGINT) // 3600, CAST(fit_time AS BIGINT) % 3600 // 60, CAST(fit_time AS BIGINT) % 60) AS fit_time FROM r""",
                            counts=_SEGMENT_COUNTS, m=_METRICS, r=_RUNS))
def run_table(spark, sf):
    return R.comparison(_runs(spark, sf), ["name", "tp", "accuracy", "business_gain", "fit_time"], ["business_gain", "name"], custom={"business_gain": 2})


@query("run_edit", V.using("scored", """
SELECT position, "name", tp FROM r WHERE position <> 4 UNION ALL SELECT 1.5::DOUBLE, 'inserted ' || "name", tp FROM r WHERE position = 5
UNION ALL SELECT 6, 'appended ' || "name", tp FROM r WHERE position = 3""", counts=_SEGMENT_COUNTS, m=_METRICS, r=_RUNS))
def run_edit(spark, sf):
    runs = _runs(spark, sf).select("position", "name", "tp")

    def copy(position, word):
        return runs.filter(F.col("position") == position).select(F.concat(F.lit(word), "name").alias("name"), "tp")

    edited = R.insert_before(runs, copy(5.0, "inserted "), 2.0)
    return R.drop_run(R.append(edited, copy(3.0, "appended ")), 4.0)


@query("merge_params", V.using("scored", """
SELECT SK_ID_CURR, 'metric__threshold=' || CAST(NATION AS VARCHAR) || ';model__c=' || CAST(TARGET AS VARCHAR) || ';model__depth=' || CAST(NATION + 1 AS VARCHAR) AS params
FROM scored"""))
def merge_params(spark, sf):
    df = star.scored_population(spark, sf)
    merged = R.merge_prefixed({
        "model": F.create_map(F.lit("c"), F.col("TARGET").cast("string"), F.lit("depth"), (F.col("NATION") + 1).cast("string")),
        "metric": F.create_map(F.lit("threshold"), F.col("NATION").cast("string"))})
    pairs = F.array_sort(F.transform(F.map_entries(merged), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return df.select("SK_ID_CURR", F.array_join(pairs, ";").alias("params"))


STREAM_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType())])


@query("stream_score", """
SELECT c_custkey AS client_id, round(1 / (1 + exp(c_acctbal / 2000 + 0.1::DOUBLE * c_nationkey)), 6) AS proba,
  CAST(1 / (1 + exp(c_acctbal / 2000 + 0.1::DOUBLE * c_nationkey)) > 0.2 AS INTEGER) AS prediction, CAST(0.2 AS DOUBLE) AS threshold FROM customer""")
def stream_score(spark, sf):
    arriving = scoring.arriving(spark, sf, STREAM_SCHEMA, "customer.parquet").select(
        F.col("c_custkey").alias("SK_ID_CURR"), F.col("c_acctbal").alias("BALANCE"), F.col("c_nationkey").alias("NATION"))

    def predict(df):
        return df.withColumn("PROBA", 1 / (1 + F.exp(F.col("BALANCE") / 2000 + 0.1 * F.col("NATION"))))

    out, state = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    scoring.start(scoring.score_stream(arriving, predict, 0.2), out, state, available_now=True).awaitTermination()
    return settled(spark.read.parquet(out))


@query("stream_static_score", V.using("scored bureau", """
SELECT SK_ID_CURR AS client_id, round(1 / (1 + exp(-(BALANCE * CAST(-0.0005 AS DOUBLE) + N_CREDITS * CAST(0.05 AS DOUBLE)))), 6) AS proba,
  CAST(1 / (1 + exp(-(BALANCE * CAST(-0.0005 AS DOUBLE) + N_CREDITS * CAST(0.05 AS DOUBLE)))) > 0.48 AS INTEGER) AS prediction, CAST(0.48 AS DOUBLE) AS threshold FROM t""", t=_TABLE))
def stream_static_score(spark, sf):
    ids = scoring.arriving(spark, sf, STREAM_SCHEMA, "customer.parquet").select(F.col("c_custkey").alias("SK_ID_CURR"))
    features = table(spark, sf).select("SK_ID_CURR", *FEATURES)

    def predict(df):
        return df.withColumn("PROBA", 1 / (1 + F.exp(-(F.col("BALANCE") * -0.0005 + F.col("N_CREDITS") * 0.05))))

    out, state = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    scoring.start(scoring.score_stream(ids, predict, 0.48, features=features), out, state, available_now=True).awaitTermination()
    return settled(spark.read.parquet(out))
