"""Preparation, classifiers and cross-validated scoring on `pyspark.ml`."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions import gain as G
from creditloom.functions.columns import decision
from creditloom.functions.naming import quoted
from creditloom.operators.metrics import confusion, evaluate, with_metrics


def impute_scale_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, mean, scale): mean of the known values and the population deviation after mean
    imputation (an imputed row adds nothing to the sum of squares). A constant column gets scale 1."""
    from creditloom.operators.profiling import per_column_structs

    # The known range tells a constant column exactly; its computed deviation may not be 0.
    return per_column_structs(df, features, lambda c: {
        "mean": f"avg({c})",
        "scale": f"CASE WHEN max({c}) > min({c}) THEN sqrt(var_pop({c}) * count({c}) / count(1)) ELSE 1D END"})


class ImputeScaleModel(Model):
    def __init__(self, stats: Mapping[str, tuple[float, float]], scale: bool = True):
        super().__init__()
        self.stats, self.scale = dict(stats), scale

    def _transform(self, dataset: DataFrame) -> DataFrame:
        def column(c: str, mean: float, spread: float) -> Column:
            v = f"coalesce(double({quoted(c)}), {mean!r}D)"
            return F.expr(f"({v} - {mean!r}D) / {spread!r}D" if self.scale else v)

        return dataset.withColumns({c: column(c, m, s) for c, (m, s) in self.stats.items()})


class ImputeScale(Estimator):
    """Mean imputation, then centring and population scaling, from one aggregate."""

    def __init__(self, features: Sequence[str], scale: bool = True):
        super().__init__()
        self.features, self.scale = list(features), scale

    def _fit(self, dataset: DataFrame) -> ImputeScaleModel:
        rows = impute_scale_stats(dataset, self.features).collect()
        return ImputeScaleModel({r["feature"]: (r["mean"] if r["mean"] is not None else 0.0, r["scale"]) for r in rows}, self.scale)


def null_indicators(df: DataFrame, features: Sequence[str], suffix: str = "_isnull") -> DataFrame:
    """0/1 columns marking missing values, for learners that cannot route NULL."""
    return df.withColumns({f"{f}{suffix}": F.col(f).isNull().cast("int") for f in features})


class NullIndicators(Transformer):
    """Adds the `null_indicators` of `features`, so that a tree can send missing values their own way after imputation."""

    def __init__(self, features: Sequence[str]):
        super().__init__()
        self.features = list(features)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return null_indicators(dataset, self.features)


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, weight) = n / (number of classes * n of the class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    every = Window.partitionBy(F.lit(0))  # one row per class
    return counts.select(label, (F.sum("n").over(every) / (F.count(F.lit(1)).over(every) * F.col("n"))).alias("weight"))


def with_balanced_weight(df: DataFrame, label: str, into: str = "weight") -> DataFrame:
    """Attach the balanced class weight as a literal (two classes, one small aggregate)."""
    weights = {r[label]: r["weight"] for r in class_weights(df, label).collect()}
    column = F.lit(1.0)
    for value, w in weights.items():
        column = F.when(F.col(label) == value, F.lit(w)).otherwise(column)
    return df.withColumn(into, column)


def majority_baseline(df: DataFrame, label: str, keep: Sequence[str] = ("SK_ID_CURR",)) -> DataFrame:
    """The most frequent class for everyone: (keep, label, PROBA, PREDICTION); ties take the smaller class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    mode = counts.agg(F.max_by(label, F.struct(F.col("n"), -F.col(label)))).scalar()
    return df.select(*keep, label, mode.cast("double").alias("PROBA"), mode.cast("int").alias("PREDICTION"))


class SummedLoss(Estimator):
    """Fits a learner whose loss is an average with the penalty that `c` means for a summed loss: 1 / (c * weight sum of the fitted rows)."""

    def __init__(self, learner: LogisticRegression, c: float, weight: str | None = None):
        super().__init__()
        self.learner, self.c, self.weight = learner, c, weight

    def _fit(self, dataset: DataFrame) -> Model:
        total = dataset.agg((F.sum(self.weight) if self.weight else F.count(F.lit(1))).alias("n")).first()["n"]
        return self.learner.copy({self.learner.regParam: 1.0 / (self.c * float(total or 1))}).fit(dataset)


def logistic(features: Sequence[str], label: str = "TARGET", weight: str | None = None, c: float = 1.0,
             l1_ratio: float = 0.0, max_iter: int = 50, fit_intercept: bool = True, tol: float = 1e-6) -> Pipeline:
    """Impute, scale, logistic regression. `c` is the inverse penalty of a summed loss."""
    model = LogisticRegression(featuresCol="features", labelCol=label, elasticNetParam=l1_ratio, maxIter=max_iter,
                               tol=tol, standardization=False, fitIntercept=fit_intercept)
    if weight:
        model = model.setWeightCol(weight)
    return Pipeline(stages=[ImputeScale(features), VectorAssembler(inputCols=list(features), outputCol="features"), SummedLoss(model, c, weight)])


class PositiveWeight(Estimator):
    """Fits a learner with positive rows weighing `times` as much, on top of their own weight. Scoring needs no label."""

    def __init__(self, learner: GBTClassifier, label: str, times: float, weight: str | None = None):
        super().__init__()
        self.learner, self.label, self.times, self.weight = learner, label, times, weight

    def _fit(self, dataset: DataFrame) -> Model:
        own = F.col(self.weight) if self.weight else F.lit(1.0)
        weighed = dataset.withColumn("_row_weight", own * F.when(F.col(self.label) == 1, self.times).otherwise(1.0))
        return self.learner.copy({self.learner.weightCol: "_row_weight"}).fit(weighed)


def boosted_trees(features: Sequence[str], label: str = "TARGET", weight: str | None = None, max_iter: int = 20,
                  max_depth: int = 5, step_size: float = 0.1, subsample: float = 1.0, seed: int = 42, min_rows: int = 1,
                  min_gain: float = 0.0, feature_share: float = 1.0, positive_weight: float = 1.0, mark_nulls: bool = False) -> Pipeline:
    """Impute (no scaling), gradient-boosted trees. `mark_nulls` adds a 0/1 column per feature, by which trees route missing values;
    `feature_share` is the share of features that a node may look at."""
    model = GBTClassifier(featuresCol="features", labelCol=label, maxIter=max_iter, maxDepth=max_depth, stepSize=step_size,
                          subsamplingRate=subsample, seed=seed, minInstancesPerNode=min_rows, minInfoGain=min_gain,
                          featureSubsetStrategy="all" if feature_share >= 1 else repr(float(feature_share)))
    if weight:
        model = model.setWeightCol(weight)
    inputs = [*features, *(f"{f}_isnull" for f in features if mark_nulls)]
    last = model if positive_weight == 1 else PositiveWeight(model, label, positive_weight, weight)
    marks = [NullIndicators(features)] if mark_nulls else []
    return Pipeline(stages=[*marks, ImputeScale(features, scale=False), VectorAssembler(inputCols=inputs, outputCol="features"), last])


# Parameters of `boosted_trees` that a search may draw, those that are whole numbers apart.
TREE_INTEGERS = ("max_iter", "max_depth", "min_rows")
TREE_REALS = ("step_size", "subsample", "min_gain", "feature_share", "positive_weight")


def trees_of(features: Sequence[str], params: Mapping[str, float], **fixed) -> Pipeline:
    """Boosted trees with the parameters of a trial; entries that belong to the decision, such as `threshold`, are left out."""
    drawn = {n: int(v) if n in TREE_INTEGERS else float(v) for n, v in params.items() if n in TREE_INTEGERS + TREE_REALS}
    return boosted_trees(features, **{**drawn, **fixed})


def predict(model: Model, df: DataFrame, keep: Sequence[str], threshold: float | None = None) -> DataFrame:
    """(keep, PROBA[, PREDICTION, THRESHOLD]) of the positive class."""
    scored = model.transform(df).select(*keep, vector_to_array("probability")[1].alias("PROBA"))
    if threshold is None:
        return scored
    return scored.withColumns({"PREDICTION": decision(F.col("PROBA"), threshold), "THRESHOLD": F.lit(threshold)})


def importances(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    """Impurity gain of a tree model, |coefficient| of a linear one. The gain of a null mark counts for its feature."""
    last, p = model.stages[-1], len(features)
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
        values = values[:p] + values[p:] if len(values) == 2 * p else values
    else:
        values = abs(last.coefficients.toArray())
    return dict(zip(features, map(float, values)))


@dataclass
class CrossValidation:
    """Out-of-fold scores (key, label, fold, PROBA) and one importance row per fold and feature."""

    scores: DataFrame
    fold_importance: DataFrame
    fit_seconds: dict[int, float]
    models: list[PipelineModel]
    train_scores: DataFrame | None = None

    def release(self) -> None:
        """Drop the kept scores, once their metrics are known."""
        self.scores.unpersist()
        if self.train_scores is not None:
            self.train_scores.unpersist()

    def metrics(self, label: str, threshold: float = 0.5, gains: Mapping[str, float] = G.UNIT_GAINS, train: bool = False) -> DataFrame:
        return evaluate(self.train_scores if train else self.scores, label, "PROBA", threshold, ["fold"], gains)


def cross_validate(df: DataFrame, features: Sequence[str], label: str, fold: str, k: int,
                   make: Callable[[Sequence[str]], Pipeline], key: str = "SK_ID_CURR", extra: Sequence[str] = (),
                   resample: Callable[[DataFrame], DataFrame] | None = None, score_train: bool = False,
                   parallelism: int = 8, cached: bool = False, threads: ThreadPool | None = None) -> CrossValidation:
    """Fit once per fold, score the held-out rows. Folds are independent jobs run from driver threads,
    so executors stay busy while one fit waits on its tree or gradient aggregate. `cached` says that
    `df` is persisted already, as the loops around this function arrange. Scores are kept too: every
    metric reads them, and they are three columns. `threads` are taken in place of new ones, as every new one has a thread in the JVM too."""
    spark = df.sparkSession
    data = df.select(key, label, fold, *extra, *features)
    data = data if cached else data.persist(StorageLevel.MEMORY_AND_DISK)

    def run(i: int):
        train = data if k == 1 else data.filter(F.col(fold) != i)
        started = time.time()
        model = make(features).fit(resample(train) if resample else train)
        seconds = time.time() - started
        held_out = predict(model, data.filter(F.col(fold) == i), [key, label, fold])
        on_train = predict(model, train.withColumn(fold, F.lit(i)), [key, label, fold]) if score_train else None
        return i, model, seconds, held_out, on_train

    with nullcontext(threads) if threads else ThreadPool(min(k, parallelism)) as pool:
        done = pool.map(inheritable_thread_target(spark)(run), range(k))
    scores, train_scores = done[0][3], done[0][4]
    for _, _, _, s, t in done[1:]:
        scores = scores.unionByName(s)
        train_scores = train_scores.unionByName(t) if score_train else None
    scores = scores.persist(StorageLevel.MEMORY_AND_DISK)
    train_scores = train_scores.persist(StorageLevel.MEMORY_AND_DISK) if score_train else None
    rows = [(f, float(v), i) for i, m, *_ in done for f, v in importances(m, features).items()]
    table = spark.createDataFrame(rows, "feature string, importance double, fold int")
    return CrossValidation(scores, table, {i: s for i, _, s, *_ in done}, [m for _, m, *_ in done], train_scores)


class BusinessGainEvaluator(Evaluator):
    """Business gain of a scored frame for `pyspark.ml` tuning."""

    def __init__(self, label: str = "TARGET", score: str = "probability", threshold: float = 0.5,
                 gains: Mapping[str, float] = G.MONEY_GAINS):
        super().__init__()
        self.label, self.score, self.threshold, self.gains = label, score, threshold, dict(gains)

    def _evaluate(self, dataset: DataFrame) -> float:
        from pyspark.ml.linalg import VectorUDT

        vector = isinstance(dataset.schema[self.score].dataType, VectorUDT)
        proba = vector_to_array(F.col(self.score))[1] if vector else F.col(self.score)
        counts = confusion(dataset.select(self.label, proba.alias("_p")), self.label, "_p", self.threshold)
        return with_metrics(counts, self.gains).first()["business_gain"]

    def isLargerBetter(self) -> bool:
        return True
