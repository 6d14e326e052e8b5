"""Properties of fitted operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.functions.hashing import key_unit
from creditloom.operators import collinearity as K
from creditloom.operators import explain as E
from creditloom.operators import models as L
from creditloom.operators import selection as S
from creditloom.operators.neighbours import nearest_neighbours
from creditloom.operators.resampling import smote, synthetic_minority
from creditloom.operators.splitting import stratified_folds
from creditloom.plans.features import Categories  # noqa: F401


@pytest.fixture(scope="module")
def population(spark):
    """1,000 rows, 8 % positives, a copy of the target and a near copy."""
    base = spark.range(1000).select(
        F.col("id").alias("SK_ID_CURR"), (F.col("id") >= 920).cast("int").alias("TARGET"),
        key_unit(F.col("id"), 1).alias("random1"), F.floor(key_unit(F.col("id"), 2) * 100).cast("double").alias("random2"))
    return base.withColumns({"to_keep": F.col("TARGET").cast("double"),
                             "to_drop": ((F.col("SK_ID_CURR") >= 920) & (F.col("SK_ID_CURR") < 993)).cast("double")})


def test_vif_drops_one_of_a_pair(population):
    model = K.VifSelector(["random1", "random2", "to_keep", "to_drop"]).fit(population)
    assert len(model.removed) == 1 and model.removed[0] in ("to_keep", "to_drop")
    assert max(model.vif.values()) < 10 and set(model.transform(population).columns) >= {"random1", "random2"}


def test_vif_equals_regressions(population):
    columns = ["random1", "random2", "to_drop"]
    x = np.array([[r[c] for c in columns] for r in population.select(*columns).collect()])
    got = {r["feature"]: r["vif"] for r in K.vif_table(population, columns).collect()}
    for j, c in enumerate(columns):
        others = np.column_stack([np.ones(len(x)), np.delete(x, j, 1)])
        residual = x[:, j] - others @ np.linalg.lstsq(others, x[:, j], rcond=None)[0]
        assert got[c] == pytest.approx(1 / (residual.var() / x[:, j].var()), rel=1e-6)


def test_exact_copy_has_infinite_vif(population):
    assert set(K.inflation(K.correlation_matrix(population.withColumn("twin", F.col("to_keep")), ["to_keep", "twin", "random1"]))[:2]) == {np.inf}


def test_variance_selector(population):
    model = K.VarianceSelector(["random1", "one"]).fit(population.withColumn("one", F.lit(1.0)))
    assert model.dropped == ["one"]


def test_impute_scale(spark):
    df = spark.createDataFrame([(1.0, 5.0), (None, 5.0), (3.0, 5.0)], "x double, c double")
    rows = L.ImputeScale(["x", "c"]).fit(df).transform(df).collect()
    scale = np.std([1.0, 2.0, 3.0])
    assert [r["x"] for r in rows] == pytest.approx([-1 / scale, 0, 1 / scale]) and [r["c"] for r in rows] == [0, 0, 0]


def test_nearest_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    # Half of the points are copies of one another, in one tight place.
    x = np.vstack([np.repeat(rng.normal(size=(10, 3)), 25, axis=0), rng.normal(size=(250, 3)) * 4])
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(x)], "SK_ID_CURR long, vec array<double>")
    got: dict = {}
    for r in nearest_neighbours(df, 4, block_rows=60).collect():
        got.setdefault(r["SK_ID_CURR"], {})[r["place"]] = (r["neighbour"], r["distance"])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    for i in range(len(x)):
        best = sorted(range(len(x)), key=lambda j: (d[i, j], j))[:4]
        assert [got[i][p][0] for p in range(1, 5)] == best
        assert [got[i][p][1] for p in range(1, 5)] == pytest.approx([d[i, j] for j in best])


def test_copies_are_limited_before_the_shuffle(spark):
    df = spark.range(3000).select(F.col("id").alias("SK_ID_CURR"), F.array(F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id") / 7)).alias("vec"))
    out = nearest_neighbours(df, 2, block_rows=500)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan or "WindowGroupLimit" in out._jdf.queryExecution().toString()
    assert out.count() == 6000
    assert [(r["neighbour"], r["distance"]) for r in out.filter("SK_ID_CURR = 2997").orderBy("place").collect()] == [(0, 0.0), (3, 0.0)]


def test_smote_reaches_parity_between_parents(population):
    made = synthetic_minority(population, ["random1", "random2"], "TARGET", block_rows=30)
    lookup = {r["SK_ID_CURR"]: r for r in population.collect()}
    rows = made.collect()
    assert len(rows) == 840
    for r in rows:
        a, b = lookup[r["parent"]], lookup[r["neighbour"]]
        assert a["TARGET"] == b["TARGET"] == 1 and r["parent"] != r["neighbour"]
        for f in ("random1", "random2"):
            assert min(a[f], b[f]) - 1e-9 <= r[f] <= max(a[f], b[f]) + 1e-9
    counts = {r["TARGET"]: r["count"] for r in smote(population, ["random1", "random2"], "TARGET").groupBy("TARGET").count().collect()}
    assert counts == {0: 920, 1: 920}


def test_shapley_golden(spark):
    f = {"": 0.4, "1": 0.5, "2": 0.6, "3": 0.55, "12": 0.7, "13": 0.65, "23": 0.72, "123": 0.8}
    df = spark.createDataFrame([(1,)], "SK_ID_CURR int")
    row = E.exact_shapley(df, ["1", "2", "3"], lambda known: F.lit(f["".join(sorted(known))])).first()
    assert row["base_value"] == 0.4
    assert [row["1"], row["2"], row["3"]] == pytest.approx([0.0933, 0.1783, 0.1283], abs=5e-5)
    assert row["base_value"] + row["1"] + row["2"] + row["3"] == pytest.approx(row["output"])


def test_sampled_shapley_is_additive_and_near_closed_form(population):
    background = E.background_rows(population, ["random1", "random2"], n=40)

    def predict(df):
        return df.withColumn("PROBA", 2 * F.col("random1") - 0.01 * F.col("random2"))

    clients = population.filter("SK_ID_CURR < 20")
    got = {(r["SK_ID_CURR"], r["feature"]): r for r in E.sampled_shapley(clients, ["random1", "random2"], background, predict, permutations=200).collect()}
    means = {f: np.mean([b[f] for b in background]) for f in ("random1", "random2")}
    for r in clients.collect():
        one, two = got[r["SK_ID_CURR"], "random1"], got[r["SK_ID_CURR"], "random2"]
        assert one["contribution"] == pytest.approx(2 * (r["random1"] - means["random1"]), abs=6 * one["std_error"] + 1e-9)
        assert two["contribution"] == pytest.approx(-0.01 * (r["random2"] - means["random2"]), abs=6 * two["std_error"] + 1e-9)


def test_cross_validation_covers_every_row_once(population):
    df = L.with_balanced_weight(stratified_folds(population, "SK_ID_CURR", "TARGET", 3), "TARGET")
    cv = L.cross_validate(df, ["random1", "to_drop"], "TARGET", "fold", 3, lambda f: L.logistic(f, weight="weight", max_iter=10), extra=["weight"])
    assert cv.scores.count() == 1000 and cv.scores.select("SK_ID_CURR").distinct().count() == 1000
    assert cv.scores.filter("PROBA < 0 or PROBA > 1").count() == 0
    scores = cv.metrics("TARGET").collect()
    assert all(r["auc"] > 0.9 for r in scores)
    assert L.BusinessGainEvaluator(score="PROBA").evaluate(cv.scores) > 0.8


def test_elimination_keeps_the_informative_feature(population):
    df = stratified_folds(population, "SK_ID_CURR", "TARGET", 2)
    history = S.eliminate(df, ["random1", "random2", "to_drop"], "TARGET", "fold", 2, lambda f: L.logistic(f, max_iter=10), min_features=1)
    assert [r["n_features"] for r in history.orderBy("iteration").collect()] == [3, 2, 1]
    assert S.best_features(history, 1) == ["to_drop"] and "to_drop" in S.best_features(history)


def test_trees_route_missing_values(spark):
    """Missing in the middle of the range: the mean hides them, the mark does not."""
    df = spark.range(400).select(
        F.col("id").alias("SK_ID_CURR"), F.when(F.col("id") % 4 != 0, (F.col("id") % 7).cast("double")).alias("x"),
        (F.col("id") % 4 == 0).cast("int").alias("TARGET"))
    model = L.boosted_trees(["x"], max_iter=3, max_depth=1, mark_nulls=True).fit(df)
    scored = L.predict(model, df.drop("TARGET"), ["SK_ID_CURR"], threshold=0.5)
    assert scored.where((F.col("PREDICTION") == 1) != (F.col("SK_ID_CURR") % 4 == 0)).count() == 0
    assert L.importances(model, ["x"]) == pytest.approx({"x": 1.0})


def test_positive_weight_raises_scores(population):
    plain, heavy = (
        L.predict(L.trees_of(["random1"], {"max_iter": 2, "max_depth": 2, "min_rows": 20, "positive_weight": w, "feature_share": 0.9, "threshold": 0.3})
                  .fit(population), population.drop("TARGET"), ["SK_ID_CURR"]).agg(F.avg("PROBA")).first()[0] for w in (1.0, 10.0))
    assert heavy > plain + 0.1


def test_sweep_of_fitted_folds_sees_every_held_out_row(population):
    df = stratified_folds(population, "SK_ID_CURR", "TARGET", 2)
    inputs = ["random1", "to_drop"]
    rows = S.fitted_sweep(df, inputs, "TARGET", "fold", 2, lambda f: L.logistic(f, max_iter=10), grid=[0.1, 0.5, 0.9],
                          resample=lambda train: smote(train, inputs, "TARGET")).collect()
    assert len(rows) == 6 and {r["tn"] + r["fp"] for r in rows} == {460} and {r["fn"] + r["tp"] for r in rows} == {40}


def test_trials_are_reproducible_and_in_range():
    a, b = S.trials(S.LOGISTIC_SPACE, 20), S.trials(S.LOGISTIC_SPACE, 20)
    assert a == b and all(1e-6 <= t["c"] <= 1e2 and 0 <= t["l1_ratio"] <= 1 for t in a)
