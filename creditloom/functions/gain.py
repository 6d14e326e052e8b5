"""Confusion-based metrics as expressions over count columns tn, fp, fn, tp."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Gain and loss of each outcome, unit scale and money scale.
UNIT_GAINS = {"gain_tp": 1, "gain_tn": 1, "loss_fp": -1, "loss_fn": -10}
MONEY_GAINS = {"gain_tp": 5000, "gain_tn": 5000, "loss_fp": -5000, "loss_fn": -50000}


def business_gain(tn: Column, fp: Column, fn: Column, tp: Column,
                  gains: Mapping[str, float] = UNIT_GAINS) -> Column:
    """Total gain min-max scaled between everything wrong (0) and everything right (1)."""
    pos, neg = tp + fn, tn + fp
    total = gains["gain_tp"] * tp + gains["gain_tn"] * tn + gains["loss_fp"] * fp + gains["loss_fn"] * fn
    best = gains["gain_tp"] * pos + gains["gain_tn"] * neg
    worst = gains["loss_fn"] * pos + gains["loss_fp"] * neg
    return F.try_divide((total - worst).cast("double"), (best - worst).cast("double"))


def accuracy(tn: Column, fp: Column, fn: Column, tp: Column) -> Column:
    return F.try_divide((tp + tn).cast("double"), (tp + tn + fp + fn).cast("double"))


def recall(fn: Column, tp: Column) -> Column:
    return F.coalesce(F.try_divide(tp.cast("double"), (tp + fn).cast("double")), F.lit(0.0))


def precision(fp: Column, tp: Column) -> Column:
    return F.coalesce(F.try_divide(tp.cast("double"), (tp + fp).cast("double")), F.lit(0.0))


def f1(fp: Column, fn: Column, tp: Column) -> Column:
    p, r = precision(fp, tp), recall(fn, tp)
    return F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))
