"""Exact Shapley values of boosted trees against a background, from the node table.

A coalition S of features takes the client's values, the other features take those of a background row; the value of S is the mean
score over the background. For one client, one background row and one leaf, only the features on the leaf's path matter: those
that only the client's value lets pass (a of them) and those that only the background's lets pass (c of them). If any
feature lets neither pass, no coalition gets there. Else the leaf gives v (a-1)! c! / (a+c)! to each of the first and takes
v a! (c-1)! / (a+c)! from each of the second. Sums over leaves, trees and background rows are exact; nothing is sampled.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.naming import quoted
from creditloom.operators.boosting import TreeModel

BATCH_ROWS = 256


def leaf_paths(model: TreeModel) -> list[tuple[float, list[tuple[int, list[tuple[float, bool, bool]]]]]]:
    """Per leaf: its value, and per feature on its path the conditions (cut, null_left, goes left)."""
    place, out = {f: j for j, f in enumerate(model.features)}, []
    for tree in model.trees:
        todo = [(0, {})]
        while todo:
            number, path = todo.pop()
            n = tree[number]
            if n.feature is None:
                out.append((n.value, sorted(path.items())))
                continue
            j = place[n.feature]
            for child, left in ((n.left, True), (n.right, False)):
                todo.append((child, {**path, j: [*path.get(j, []), (n.cut, n.null_left, left)]}))
    return out


def _passes(x: np.ndarray, path) -> np.ndarray:
    """Per row the set of path features, as bits, whose value lets the row pass."""
    bits = np.zeros(len(x), np.int64)
    for i, (j, conditions) in enumerate(path):
        v, ok = x[:, j], np.ones(len(x), bool)
        for cut, null_left, left in conditions:
            goes = np.where(np.isnan(v), null_left, v <= cut)
            ok &= goes if left else ~goes
        bits |= ok.astype(np.int64) << i
    return bits


def _shares(x_bits: np.ndarray, b_bits: np.ndarray, d: int, value: float) -> np.ndarray:
    """Contribution of each of d features for every pair of bit sets: (x sets, background sets, d)."""
    out = np.zeros((len(x_bits), len(b_bits), d))
    for i, x in enumerate(x_bits.tolist()):
        for k, b in enumerate(b_bits.tolist()):
            if x | b != (1 << d) - 1:
                continue
            mine, theirs = x & ~b, b & ~x
            a, c = mine.bit_count(), theirs.bit_count()
            for f in range(d):
                if mine >> f & 1:
                    out[i, k, f] = value * factorial(a - 1) * factorial(c) / factorial(a + c)
                elif theirs >> f & 1:
                    out[i, k, f] = -value * factorial(a) * factorial(c - 1) / factorial(a + c)
    return out


def _margins(x: np.ndarray, base: float, paths) -> np.ndarray:
    total = np.full(len(x), base)
    for value, path in paths:
        total += value * (_passes(x, path) == (1 << len(path)) - 1)
    return total


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-z))


def shapley_rows(x: np.ndarray, background: np.ndarray, base: float, paths, probability: bool = False) -> tuple[np.ndarray, np.ndarray, float]:
    """Contributions (rows x features), outputs and base value.

    In log odds they are exact Shapley values. As probabilities, the contributions against each background row are scaled by the step in
    probability over the step in log odds between the two, so that they add up as well.
    """
    f_b = _margins(background, base, paths)
    f_x = _margins(x, base, paths)
    if not probability:
        phi = np.zeros(x.shape)
        for value, path in paths:
            if path:
                b_bits, counts = np.unique(_passes(background, path), return_counts=True)
                x_bits, which = np.unique(_passes(x, path), return_inverse=True)
                mean = np.einsum("xbd,b->xd", _shares(x_bits, b_bits, len(path), value), counts / len(background))
                for i, (j, _) in enumerate(path):
                    phi[:, j] += mean[which, i]
        return phi, f_x, float(f_b.mean())
    pairs = np.zeros((len(x), len(background), x.shape[1]))
    for value, path in paths:
        if path:
            b_bits, b_which = np.unique(_passes(background, path), return_inverse=True)
            x_bits, x_which = np.unique(_passes(x, path), return_inverse=True)
            shares = _shares(x_bits, b_bits, len(path), value)
            for i, (j, _) in enumerate(path):
                pairs[:, :, j] += shares[:, :, i][x_which][:, b_which]
    step = f_x[:, None] - f_b[None, :]
    same = np.abs(step) < 1e-12
    p_x, p_b = _sigmoid(f_x), _sigmoid(f_b)
    scale = np.where(same, (p_x * (1 - p_x))[:, None], (p_x[:, None] - p_b[None, :]) / np.where(same, 1.0, step))
    return (pairs * scale[:, :, None]).mean(axis=1), p_x, float(p_b.mean())


def tree_contributions(df: DataFrame, model: TreeModel, background: Sequence[Mapping[str, float | None]], keep: Sequence[str] = ("SK_ID_CURR",),
                       probability: bool = False) -> DataFrame:
    """(keep, base_value, one column per feature, output): base_value + contributions = output for every row.

    `background` is a bounded list of reference rows (see `explain.background_rows`); it and the node table go to every task. NULL
    takes the way that each split gives it. No shuffle.
    """
    if not background:
        raise ValueError("contributions are measured against a background; it is empty")
    features, paths = model.features, leaf_paths(model)
    base, reference = model.base, np.array([[np.nan if b[f] is None else float(b[f]) for f in features] for b in background])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in range(0, len(batch), BATCH_ROWS):
                part = batch.iloc[i:i + BATCH_ROWS]
                x = part[[f"x{j}" for j in range(len(features))]].to_numpy(float, na_value=np.nan)
                phi, output, mean = shapley_rows(x, reference, base, paths, probability)
                yield part[[f"k{j}" for j in range(len(keep))]].assign(b=mean, **{f"p{j}": phi[:, j] for j in range(len(features))}, o=output)

    rows = df.select(*[F.col(quoted(k)).alias(f"k{j}") for j, k in enumerate(keep)], *[F.col(quoted(f)).cast("double").alias(f"x{j}") for j, f in enumerate(features)])
    kinds = ", ".join(f"k{j} {rows.schema[f'k{j}'].dataType.simpleString()}" for j in range(len(keep)))
    found = rows.mapInPandas(run, f"{kinds}, b double, {', '.join(f'p{j} double' for j in range(len(features)))}, o double")
    return found.toDF(*keep, "base_value", *features, "output")
