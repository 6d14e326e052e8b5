"""Feature selection and parameter search around cross-validation."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions import gain as G
from creditloom.operators.metrics import confusion, roc_auc, score_totals, threshold_sweep, with_metrics
from creditloom.operators.models import cross_validate
from creditloom.operators.search import Study, run
from creditloom.session import collect_garbage, scratch_path


@contextmanager
def kept(df: DataFrame, features: Sequence[str], label: str, fold: str, key: str, extra: Sequence[str]) -> Iterator[DataFrame]:
    """The columns all rounds read, persisted for the length of a loop."""
    data = df.select(key, label, fold, *extra, *features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield data
    finally:
        data.unpersist()


ROWS_PER_TASK = 100_000


def packed(data: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Persisted rows in as many partitions as their number asks for, without a shuffle. A search starts hundreds of jobs over them,
    each of a few milliseconds a partition, so that partitions left over from a shuffle of few rows cost more than the rows."""
    return data.coalesce(max(1, -(-data.count() // rows_per_task)))


HISTORY = "iteration int, n_features int, auc double, features array<string>, removed array<string>"


def eliminate(df: DataFrame, features: Sequence[str], label: str, fold: str, k: int, make: Callable[[Sequence[str]], Pipeline],
              min_features: int = 100, step: float = 1, key: str = "SK_ID_CURR", extra: Sequence[str] = (),
              score_digits: int | None = None, **kw) -> DataFrame:
    """Recursive elimination history: (iteration, n_features, auc, features, removed).

    `score_digits` rounds scores before they are ranked, so that those which differ only by the optimiser's tolerance tie.

    Each round drops the least important features: `step` of them, or that share of what is left
    when below 1, which bounds the number of rounds by a logarithm.
    """
    left, rows, i = list(features), [], 0
    with kept(df, features, label, fold, key, extra) as data:
        while left:
            i += 1
            cv = cross_validate(data, left, label, fold, k, make, key, extra, cached=True, **kw)
            scores = cv.scores if score_digits is None else cv.scores.withColumn("PROBA", F.round("PROBA", score_digits))
            per_fold = roc_auc(score_totals(scores, label, "PROBA", [fold]), [fold])
            auc = per_fold.agg(F.avg("auc")).first()[0]
            cv.release()
            means: dict[str, float] = {}
            for r in cv.fold_importance.collect():
                means[r["feature"]] = means.get(r["feature"], 0.0) + r["importance"] / k
            size = max(1, int(len(left) * step) if step < 1 else int(step))
            drop = sorted(left, key=lambda f: (means[f], f))[:max(min(size, len(left) - min_features), 0)]
            rows.append((i, len(left), float(auc), list(left), drop))
            if not drop:
                break
            left = [f for f in left if f not in drop]
    return df.sparkSession.createDataFrame(rows, HISTORY)


def best_features(history: DataFrame, n_features: int | None = None) -> list[str]:
    """Features of the best AUC (fewest on a tie), or of an exact count."""
    if n_features is not None:
        history = history.filter(F.col("n_features") == n_features)
    row = history.agg(F.max_by("features", F.struct(F.col("auc"), -F.col("n_features")))).first()
    return list(row[0]) if row and row[0] else []


def history_view(history: DataFrame, low: int, high: int) -> DataFrame:
    """Rounds with a feature count in [low, high], best AUC first."""
    return history.filter(F.col("n_features").between(low, high)).orderBy(F.col("auc").desc(), "n_features")


# Candidate feature counts and the loss of gain that stops the search.
ELBOW_SIZES = (424, 60, 40, 20, 10)
ELBOW_LOSS = 0.01


def elbow(df: DataFrame, ordered_features: Sequence[str], label: str, fold: str, k: int, make: Callable[[Sequence[str]], Pipeline],
          sizes: Sequence[int] = ELBOW_SIZES, loss: float = ELBOW_LOSS, threshold: float = 0.5, key: str = "SK_ID_CURR",
          extra: Sequence[str] = (), **kw) -> DataFrame:
    """(n_features, gain_train, gain_val, fit_ms): ever fewer of the best features until the gain falls too far."""
    rows, start = [], None
    with kept(df, list(ordered_features)[:max(sizes)], label, fold, key, extra) as data:
        for size in sizes:
            features = list(ordered_features)[:size]
            cv = cross_validate(data, features, label, fold, k, make, key, extra, score_train=True, cached=True, **kw)
            val, train = (
                with_metrics(confusion(s, label, "PROBA", threshold, [fold])).agg(F.avg("business_gain")).first()[0]
                for s in (cv.scores, cv.train_scores))
            cv.release()
            rows.append((len(features), float(train), float(val), sum(cv.fit_seconds.values()) / k * 1000))
            start = val if start is None else start
            if val < start - loss:
                break
    return df.sparkSession.createDataFrame(rows, "n_features int, gain_train double, gain_val double, fit_ms double")


# Search ranges of the logistic model and of the tree model; the tree ranges from `min_rows` on are chosen here.
LOGISTIC_SPACE = {"c": ("log", 1e-6, 1e2), "l1_ratio": ("float", 0.0, 1.0), "threshold": ("float", 0.1, 0.9)}
TREE_SPACE = {"step_size": ("log", 0.01, 0.3), "max_iter": ("int", 10, 50), "max_depth": ("int", 2, 6),
              "subsample": ("float", 0.5, 1.0), "min_rows": ("int", 1, 100), "min_gain": ("float", 0.0, 0.01),
              "feature_share": ("float", 0.5, 1.0), "positive_weight": ("float", 1.0, 12.0), "threshold": ("float", 0.1, 0.9)}


def trials(space: Mapping[str, tuple], n: int, seed: int = 42) -> list[dict[str, float]]:
    """n seeded draws from a space of (kind, low, high); a list of values is drawn from as it is."""
    rng = random.Random(seed)

    def draw(spec):
        if isinstance(spec, list):
            return rng.choice(spec)
        kind, low, high = spec
        if kind == "log":
            return low * (high / low) ** rng.random()
        return rng.randint(low, high) if kind == "int" else low + (high - low) * rng.random()

    return [{name: draw(spec) for name, spec in space.items()} for _ in range(n)]


def search(df: DataFrame, features: Sequence[str], label: str, fold: str, k: int,
           make: Callable[[Sequence[str], Mapping[str, float]], Pipeline], candidates: Sequence[Mapping[str, float]],
           gains: Mapping[str, float] = G.UNIT_GAINS, key: str = "SK_ID_CURR", extra: Sequence[str] = (), **kw) -> DataFrame:
    """(trial, params, business_gain, auc): mean cross-validated scores of every candidate."""
    rows = []
    with kept(df, features, label, fold, key, extra) as data:
        for i, params in enumerate(candidates):
            cv = cross_validate(data, features, label, fold, k, lambda f, p=params: make(f, p), key, extra, cached=True, **kw)
            scored = cv.metrics(label, params.get("threshold", 0.5), gains)
            gain, auc = scored.agg(F.avg("business_gain"), F.avg("auc")).first()
            cv.release()
            rows.append((i, {n: float(v) for n, v in params.items()}, gain, auc))
    return df.sparkSession.createDataFrame(rows, "trial int, params map<string,double>, business_gain double, auc double")


def model_search(df: DataFrame, features: Sequence[str], label: str, fold: str, k: int, make: Callable[[Sequence[str], Mapping[str, float], float], Pipeline],
                 study: Study, n: int, rungs: Sequence[float] = (1.0,), reduction: float = 3.0, gains: Mapping[str, float] = G.UNIT_GAINS,
                 key: str = "SK_ID_CURR", extra: Sequence[str] = (), **kw) -> DataFrame:
    """(trial, params, state, business_gain, auc, history): a search of `n` trials by `search.Study` over mean cross-validated gains.

    `make(features, params, share)` builds the model for a share of the full budget, such as rounds; a stopped trial keeps the scores of its last rung.
    """
    aucs: list[float] = []
    # Every job of a fit carries the plan of its rows; that of stored rows is short.
    path = scratch_path(df.sparkSession, "search-rows")
    df.select(key, label, fold, *extra, *features).write.parquet(path)
    with ThreadPool(min(k, 8)) as threads, kept(df.sparkSession.read.parquet(path), features, label, fold, key, extra) as held:
        data = packed(held)

        def measure(params: Mapping[str, float], share: float) -> float:
            cv = cross_validate(data, features, label, fold, k, lambda f: make(f, params, share), key, extra, cached=True, **{"threads": threads, **kw})
            gain, auc = cv.metrics(label, params.get("threshold", 0.5), gains).agg(F.avg("business_gain"), F.avg("auc")).first()
            cv.release()
            collect_garbage(df.sparkSession)
            aucs[len(study.trials):] = [auc]
            return gain

        run(study, measure, n, rungs, reduction)
    rows = [(i, t["params"], t["state"], t["value"], a, t["history"]) for i, (t, a) in enumerate(zip(study.trials, aucs, strict=True))]
    return df.sparkSession.createDataFrame(rows, "trial int, params map<string,double>, state string, business_gain double, auc double, history array<double>")


def best_trial(results: DataFrame) -> DataFrame:
    """The trial of greatest gain, the first on a tie."""
    return results.agg(F.max_by(F.struct("trial", "params", "business_gain", "auc"),
                                F.struct(F.col("business_gain"), -F.col("trial"))).alias("r")).select("r.*")


def fitted_sweep(df: DataFrame, features: Sequence[str], label: str, fold: str, k: int, make: Callable[[Sequence[str]], Pipeline],
                 grid: Sequence[float] | None = None, gains: Mapping[str, float] = G.UNIT_GAINS, key: str = "SK_ID_CURR",
                 extra: Sequence[str] = (), **kw) -> DataFrame:
    """Threshold sweep (see `metrics.threshold_sweep`) over held-out scores: each fold is resampled (`resample`) and fitted once,
    and one pass over its scores gives all thresholds. k times len(grid) rows come back."""
    with kept(df, features, label, fold, key, extra) as data:
        cv = cross_validate(data, features, label, fold, k, make, key, extra, cached=True, **kw)
        sweep = threshold_sweep(cv.scores, label, "PROBA", fold, grid, gains)
        rows = sweep.collect()
        cv.release()
    return df.sparkSession.createDataFrame(rows, sweep.schema)
