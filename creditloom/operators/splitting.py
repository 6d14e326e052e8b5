"""Reproducible stratified splits and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.hashing import key_unit
from creditloom.operators.ordered import digest_rank

SEED = 42


def _attach(df: DataFrame, key: str, target: str, seed: int, into: str, value: Column) -> DataFrame:
    """Add `value`, an expression over `rank` and `stratum_size`. Every row is ranked as it is, whatever its width: rows with a
    NULL or a repeated key each get their own place."""
    return digest_rank(df, key, [target], seed).withColumn(into, value).drop("rank", "stratum_size")


def hash_split(df: DataFrame, key: str, fraction: float, seed: int = SEED, into: str = "in_sample") -> DataFrame:
    """0/1 flag from the key alone: no shuffle, shares are approximate."""
    return df.withColumn(into, (key_unit(F.col(key), seed) < fraction).cast("int"))


def stratified_split(df: DataFrame, key: str, target: str, fraction: float, seed: int = SEED,
                     into: str = "in_sample") -> DataFrame:
    """0/1 flag marking exactly round(fraction * n) rows of each target class."""
    size = F.round(F.col("stratum_size") * F.lit(fraction))
    return _attach(df, key, target, seed, into, (F.col("rank") <= size).cast("int"))


def stratified_folds(df: DataFrame, key: str, target: str, k: int = 5, seed: int = SEED, into: str = "fold") -> DataFrame:
    """Fold numbers 0..k-1 with class counts that differ by at most one between folds."""
    return _attach(df, key, target, seed, into, F.pmod(F.col("rank") - 1, F.lit(k)).cast("int"))


def single_fold(df: DataFrame, into: str = "fold") -> DataFrame:
    """Cross-validation switched off: one fold, trained and validated on every row."""
    return df.withColumn(into, F.lit(0))


def take_part(df: DataFrame, flag: str, value: int) -> DataFrame:
    """Rows of one part, without the flag column."""
    return df.filter(F.col(flag) == value).drop(flag)
