"""Confusion counts, threshold metrics and ranking curves over a scored table (label, score)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions import gain as G
from creditloom.functions.columns import decision
from creditloom.operators.ordered import running_totals


def confusion(df: DataFrame, label: str, score: str, threshold: float, groups: Sequence[str] = (),
              inclusive: bool = False) -> DataFrame:
    """(groups, tn, fp, fn, tp) in one aggregate."""
    predicted = decision(F.col(score), threshold, inclusive)

    def cell(y: int, p: int) -> Column:
        return F.count(F.when((F.col(label) == y) & (predicted == p), 1))

    return df.groupBy(*groups).agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"),
                                   cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def with_metrics(counts: DataFrame, gains: Mapping[str, float] = G.UNIT_GAINS) -> DataFrame:
    """Add accuracy, recall, precision, f1_score and business_gain to confusion counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns({
        "accuracy": G.accuracy(tn, fp, fn, tp), "recall": G.recall(fn, tp), "precision": G.precision(fp, tp),
        "f1_score": G.f1(fp, fn, tp), "business_gain": G.business_gain(tn, fp, fn, tp, gains),
    })


def normalised_confusion(counts: DataFrame) -> DataFrame:
    """Rows of the confusion matrix as shares; counts are rounded half-even first."""
    tn, fp, fn, tp = (F.bround(F.col(c).cast("double")) for c in ("tn", "fp", "fn", "tp"))
    keep = [c for c in counts.columns if c not in ("tn", "fp", "fn", "tp")]
    return counts.select(
        *keep, F.try_divide(tn, tn + fp).alias("tn_rate"), F.try_divide(fp, tn + fp).alias("fp_rate"),
        F.try_divide(fn, fn + tp).alias("fn_rate"), F.try_divide(tp, fn + tp).alias("tp_rate"))


def score_totals(df: DataFrame, label: str, score: str, groups: Sequence[str] = (), **kw) -> DataFrame:
    """Distinct scores, best first, with running and total positives and negatives."""
    per_score = df.groupBy(*groups, F.col(score).alias("threshold")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) == 0, 1)).alias("neg"))
    raw = df.select(F.col(score).alias("threshold"))
    return running_totals(per_score, "threshold", ["pos", "neg"], groups, ascending=False, splits_from=raw, **kw)


def roc_points(totals: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, threshold, fpr, tpr) per distinct score."""
    return totals.select(*groups, "threshold",
                         F.try_divide(F.col("cum_neg").cast("double"), F.col("all_neg").cast("double")).alias("fpr"),
                         F.try_divide(F.col("cum_pos").cast("double"), F.col("all_pos").cast("double")).alias("tpr"))


def roc_auc(totals: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, auc): trapezoids, so tied scores count half."""
    area = F.sum(F.col("neg") * (F.col("before_pos") + F.col("cum_pos")) / 2.0)
    return totals.groupBy(*groups).agg(
        F.try_divide(area, F.max("all_pos").cast("double") * F.max("all_neg")).alias("auc"))


def precision_recall(totals: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """(groups, threshold, precision, recall) per distinct score."""
    hits = F.col("cum_pos").cast("double")
    return totals.select(*groups, "threshold",
                         (hits / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
                         F.try_divide(hits, F.col("all_pos").cast("double")).alias("recall"))


def best_threshold(points: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """Score with the greatest tpr - fpr; the highest score wins a tie."""
    gap = F.col("tpr") - F.col("fpr")
    return points.groupBy(*groups).agg(
        F.max_by("threshold", F.struct(gap, F.col("threshold"))).alias("best_threshold"), F.max(gap).alias("best_gap"))


def roc_on_grid(totals: DataFrame, groups: Sequence[str], steps: int = 99) -> DataFrame:
    """tpr of each group interpolated at fpr = 0, 1/steps, ..., 1: (groups, step, tpr).

    Each ROC segment emits the grid points it covers, found with integer arithmetic, so there is no
    range join: the output has steps + 1 rows per group. The curve starts at (0, 0).
    """
    n, p = F.col("all_neg"), F.col("all_pos").cast("double")
    first = F.floor((F.col("before_neg") * steps + n - 1) / n)
    last = F.when(F.col("cum_neg") == n, F.lit(steps)).otherwise(F.floor((F.col("cum_neg") * steps + n - 1) / n) - 1)
    rising = totals.filter("neg > 0 and all_pos > 0").withColumn("first", first).withColumn("last", last)
    points = rising.filter("first <= last").withColumn("step", F.explode(F.sequence("first", "last")))
    x = F.col("step") * n / F.lit(float(steps))
    y = (F.col("before_pos") + F.least(x - F.col("before_neg"), F.col("neg").cast("double")) / F.col("neg") * F.col("pos")) / p
    return points.select(*groups, F.col("step").cast("int").alias("step"), F.when(F.col("step") == 0, 0.0).otherwise(y).alias("tpr"))


def mean_roc(grid: DataFrame, steps: int = 99) -> DataFrame:
    """Mean curve over folds with a one-standard-deviation band clipped to [0, 1]."""
    folded = grid.groupBy("step").agg(F.avg("tpr").alias("mean_tpr"), F.stddev_pop("tpr").alias("std_tpr"))
    return folded.select(
        "step", (F.col("step") / F.lit(float(steps))).alias("fpr"), "mean_tpr", "std_tpr",
        F.least(F.col("mean_tpr") + F.col("std_tpr"), F.lit(1.0)).alias("tpr_upper"),
        F.greatest(F.col("mean_tpr") - F.col("std_tpr"), F.lit(0.0)).alias("tpr_lower"))


def mean_roc_auc(curve: DataFrame, steps: int = 99) -> DataFrame:
    """Area under the mean curve: (mean_auc). End points weigh half, so no ordering is needed."""
    weight = F.when(F.col("step").isin(0, steps), 0.5).otherwise(1.0)
    return curve.agg((F.sum(F.col("mean_tpr") * weight) / steps).alias("mean_auc"))


def thresholds(n: int = 99, start: float = 0.01, stop: float = 0.99) -> list[float]:
    step = (stop - start) / (n - 1)
    return [i * step + start for i in range(n)]


def threshold_sweep(df: DataFrame, label: str, score: str, fold: str, grid: Sequence[float] | None = None,
                    gains: Mapping[str, float] = G.UNIT_GAINS) -> DataFrame:
    """Business gain per fold and threshold: (fold, threshold, tn, fp, fn, tp, business_gain).

    Scores fall into the interval between two thresholds once; cumulative counts over at most
    len(grid) + 1 rows per fold then give all confusion matrices. A score equal to a threshold
    counts as refused.
    """
    grid = list(grid if grid is not None else thresholds())
    binned = Bucketizer(splits=[float("-inf"), *grid, float("inf")], inputCol=score, outputCol="_bin").transform(
        df.select(fold, label, F.col(score).cast("double").alias(score)))
    per_bin = binned.groupBy(fold, F.col("_bin").cast("int").alias("_bin")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("pos"), F.count(F.when(F.col(label) == 0, 1)).alias("neg"))
    # One row per fold holding the counts as maps keeps every threshold, also those no score falls in.
    per_fold = per_bin.groupBy(fold).agg(
        F.map_from_entries(F.collect_list(F.struct("_bin", F.struct("pos", "neg")))).alias("bins"),
        F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    steps = per_fold.select(fold, "bins", "all_pos", "all_neg", F.explode(F.sequence(F.lit(1), F.lit(len(grid)))).alias("_i"))
    below = F.filter(F.map_entries("bins"), lambda e: e["key"] < F.col("_i"))

    def count_below(name: str) -> Column:
        return F.aggregate(below, F.lit(0).cast("bigint"), lambda acc, e: acc + e["value"][name])

    counts = steps.select(
        fold, F.element_at(F.lit(grid), F.col("_i")).alias("threshold"),
        count_below("neg").alias("tn"), (F.col("all_neg") - count_below("neg")).alias("fp"),
        count_below("pos").alias("fn"), (F.col("all_pos") - count_below("pos")).alias("tp"))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumn("business_gain", G.business_gain(tn, fp, fn, tp, gains))


def sweep_summary(sweep: DataFrame) -> DataFrame:
    """Mean, population deviation and band of the gain per threshold."""
    out = sweep.groupBy("threshold").agg(F.avg("business_gain").alias("mean_gain"), F.stddev_pop("business_gain").alias("std_gain"))
    return out.withColumns({"upper": F.col("mean_gain") + F.col("std_gain"), "lower": F.col("mean_gain") - F.col("std_gain")})


def best_gain(summary: DataFrame) -> DataFrame:
    """(best_threshold, best_gain): the lowest threshold wins a tie."""
    return summary.agg(
        F.max_by("threshold", F.struct(F.col("mean_gain"), -F.col("threshold"))).alias("best_threshold"),
        F.max("mean_gain").alias("best_gain"))


def fold_summary(scores: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each metric over folds: (metric, mean, std)."""
    cells = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics]))
    return scores.select(cells.alias("c")).select("c.*").groupBy("metric").agg(
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("std"))


def evaluate(df: DataFrame, label: str, score: str, threshold: float, groups: Sequence[str] = ("fold",),
             gains: Mapping[str, float] = G.UNIT_GAINS) -> DataFrame:
    """All metrics per group: confusion counts, threshold metrics and AUC.

    Everything comes from the counts per distinct score, so the scored rows are read once.
    """
    groups = list(groups)
    refused = decision(F.col("threshold"), threshold) == 1

    def cell(count: str, positive: bool) -> Column:
        return F.coalesce(F.sum(F.when(refused if positive else ~refused, F.col(count))), F.lit(0))

    area = F.sum(F.col("neg") * (F.col("before_pos") + F.col("cum_pos")) / 2.0)
    counts = score_totals(df, label, score, groups).groupBy(*groups).agg(
        cell("neg", False).alias("tn"), cell("neg", True).alias("fp"), cell("pos", False).alias("fn"), cell("pos", True).alias("tp"),
        F.try_divide(area, F.max("all_pos").cast("double") * F.max("all_neg")).alias("auc"))
    return with_metrics(counts, gains)
