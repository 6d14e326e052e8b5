"""Variance inflation: one distributed correlation pass, elimination on the small matrix."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.operators.profiling import low_variance, null_guard


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """p x p on the driver; p is the number of columns. NULL is an error, as in the regressions it replaces."""
    null_guard(df.select(*columns))
    vectors = VectorAssembler(inputCols=list(columns), outputCol="_v").transform(df).select("_v")
    return Correlation.corr(vectors, "_v").first()[0].toArray()


def inflation(corr: np.ndarray, epsilon: float = 1e-6) -> np.ndarray:
    """VIF of each column: diagonal of the inverse, infinite when 1 - R² < epsilon. A constant column has no correlation
    (NaN with every other) and cannot inflate anything: its VIF is 1."""
    p = corr.shape[0]
    constant = (np.isnan(corr) | np.eye(p, dtype=bool)).all(axis=1) & (p > 1)
    if constant.any():
        out, rest = np.ones(p), np.flatnonzero(~constant)
        if len(rest):
            out[rest] = inflation(corr[np.ix_(rest, rest)], epsilon)
        return out
    if np.isnan(corr).any():
        raise ValueError("a correlation is not a number")
    if p == 1:
        return np.ones(1)
    try:
        diagonal = np.diag(np.linalg.inv(corr))
        if np.all(diagonal >= 1 - 1e-6) and np.all(diagonal < 1 / epsilon):
            return diagonal
    except np.linalg.LinAlgError:
        pass
    # Near-singular: residual variance of each column on the others through the pseudo-inverse.
    out = np.empty(p)
    for j in range(p):
        rest = np.delete(np.arange(p), j)
        r = corr[rest, j]
        left = 1.0 - r @ np.linalg.pinv(corr[np.ix_(rest, rest)], hermitian=True) @ r
        out[j] = np.inf if left < epsilon else 1.0 / left
    return out


# Added to the diagonal of a correlation matrix without an inverse; columns that depend on others then stand out by it.
RIDGE = 1e-10
# An inverse is downdated up to this inflation of the leaving column, where a step loses few digits, and this many times in a row.
SWEEP_INFLATION, SWEEP_STEPS = 1e4, 50


def _inverse(corr: np.ndarray, epsilon: float) -> np.ndarray:
    try:
        inverse = np.linalg.inv(corr)
        if np.all(np.diag(inverse) >= 1 - 1e-6) and np.all(np.diag(inverse) < 1 / epsilon):
            return inverse
    except np.linalg.LinAlgError:
        pass
    return np.linalg.inv(corr + RIDGE * np.eye(len(corr)))


def swept(inverse: np.ndarray, j: int) -> np.ndarray:
    """The inverse after column j left: one sweep step on its pivot, p² instead of p³ operations."""
    rest = np.delete(np.arange(len(inverse)), j)
    return inverse[np.ix_(rest, rest)] - np.outer(inverse[rest, j], inverse[j, rest]) / inverse[j, j]


def eliminated(corr: np.ndarray, threshold: float, max_iter: int = 0, epsilon: float = 1e-6) -> list[int]:
    """Columns in the order they leave: always the one of greatest VIF (the first of equals, to nine digits), until all are below the
    threshold. A constant column has a VIF of 1; `max_iter` removals at most, 0 means no bound."""
    p = len(corr)
    constant = (np.isnan(corr) | np.eye(p, dtype=bool)).all(axis=1)
    corr = np.where(np.eye(p, dtype=bool), 1.0, np.where(constant[:, None] | constant[None, :], 0.0, corr))
    if np.isnan(corr).any():
        raise ValueError("a correlation is not a number")
    left, out, steps = np.arange(p), [], 0
    inverse = _inverse(corr, epsilon) if p else corr
    while len(left) and not (max_iter and len(out) == max_iter):
        values = np.maximum(np.diag(inverse), 1.0)
        values = np.where(values > 1 / epsilon, np.inf, values)
        top = values.max()
        if top < threshold:
            break
        worst = int(np.flatnonzero((values >= top * (1 - 1e-9)) | (values == top))[0])
        out.append(int(left[worst]))
        left = np.delete(left, worst)
        if top < SWEEP_INFLATION and steps < SWEEP_STEPS:
            inverse, steps = swept(inverse, worst), steps + 1
        elif len(left):
            inverse, steps = _inverse(corr[np.ix_(left, left)], epsilon), 0
    return out


def vif_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, vif)."""
    values = inflation(correlation_matrix(df, columns))
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(columns, values)], "feature string, vif double")


def vif_band(vif: Column) -> Column:
    """low below 5, watch below 10, high from 10."""
    return F.when(vif < 5, "low").when(vif < 10, "watch").otherwise("high")


class VifModel(Model):
    """Drops the columns found collinear."""

    def __init__(self, selected: list[str], removed: list[str], vif: dict[str, float]):
        super().__init__()
        self.selected, self.removed, self.vif = selected, removed, vif

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.removed)


class VifSelector(Estimator):
    """Removes the worst column until every VIF is below the threshold."""

    def __init__(self, columns: Sequence[str], threshold: float = 10.0, max_iter: int = 100, epsilon: float = 1e-6):
        super().__init__()
        self.columns, self.threshold, self.max_iter, self.epsilon = list(columns), threshold, max_iter, epsilon

    def _fit(self, dataset: DataFrame) -> VifModel:
        corr = correlation_matrix(dataset, self.columns)
        gone = eliminated(corr, self.threshold, self.max_iter, self.epsilon)
        left = np.delete(np.arange(len(corr)), gone)
        names, removed = [self.columns[i] for i in left], [self.columns[i] for i in gone]
        corr = corr[np.ix_(left, left)]
        vif = dict(zip(names, map(float, inflation(corr, self.epsilon)))) if names else {}
        return VifModel(names, removed, vif)


class ColumnDropModel(Model):
    def __init__(self, dropped: list[str]):
        super().__init__()
        self.dropped = dropped

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.drop(*self.dropped)


class VarianceSelector(Estimator):
    """Drops columns whose sample variance on the fitted rows does not exceed the threshold."""

    def __init__(self, columns: Sequence[str], threshold: float = 0.0):
        super().__init__()
        self.columns, self.threshold = list(columns), threshold

    def _fit(self, dataset: DataFrame) -> ColumnDropModel:
        return ColumnDropModel(low_variance(dataset, self.columns, self.threshold))
