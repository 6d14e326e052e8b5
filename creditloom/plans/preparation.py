"""From the wide feature table to train and test sets, and to aligned features of new loans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame

from creditloom.operators.cleaning import align, cast_columns, infinities_to_null, predictors, type_mismatch
from creditloom.operators.profiling import binary_to_bool, narrow, per_column_structs
from creditloom.operators.splitting import SEED, stratified_split
from creditloom.plans.features import Categories, LoanTables, feature_table, limited_to


@dataclass
class Prepared:
    """`data` carries the flag column `is_test`."""

    data: DataFrame
    constant: list[str]
    empty: list[str]


def flagged(features: DataFrame, key: str = "SK_ID_CURR", target: str = "TARGET", test_share: float = 0.25, seed: int = SEED) -> DataFrame:
    """Infinities to NULL and the flag `is_test` of an exact stratified split."""
    return stratified_split(infinities_to_null(features), key, target, test_share, seed, "is_test")


def screened(split: DataFrame, key: str = "SK_ID_CURR", target: str = "TARGET", threshold: float = 0.0) -> Prepared:
    """Constant and empty columns of the training part go from both parts. One aggregate over the training rows finds both kinds."""
    columns = predictors(split, (key, target, "is_test"))
    facts = per_column_structs(split.filter("is_test = 0"), columns, lambda c: {
        "variance": f"var_samp(double({c}))", "known": f"count({c})"}).collect()
    constant = [r["feature"] for r in facts if r["variance"] is not None and r["variance"] <= threshold]
    empty = [r["feature"] for r in facts if r["known"] == 0]
    return Prepared(split.drop(*constant, *empty), constant, empty)


def clean_and_split(features: DataFrame, key: str = "SK_ID_CURR", target: str = "TARGET", test_share: float = 0.25,
                    seed: int = SEED, threshold: float = 0.0) -> Prepared:
    """`flagged`, then `screened`. Both read `features` anew; store the flagged table in between where it is costly."""
    return screened(flagged(features, key, target, test_share, seed), key, target, threshold)


def compact(df: DataFrame, key: str = "SK_ID_CURR", target: str = "TARGET") -> DataFrame:
    """0/1 columns to boolean, other numbers to the narrowest type of their observed range."""
    return narrow(binary_to_bool(df, (key, target)), exclude=(key, target))


def new_loan_features(tables: LoanTables, features: Sequence[str], categories: Categories,
                      types: Mapping[str, str] | None = None) -> tuple[DataFrame, list[str], list[str]]:
    """The training pipeline on new applications, with the training categories and no dropped first
    category, aligned to the training features. Only the new applicants' satellite rows are rolled up, if the categories of all tables are
    known. Also returns both kinds of dictionary mismatch."""
    known = {f.name for f in fields(tables)} <= set(categories.tables)
    built = infinities_to_null(feature_table(limited_to(tables, tables.application) if known else tables, categories, drop_first=False))
    out = align(built, features)
    unused, untyped = type_mismatch(features, types or {})
    return (cast_columns(out, types) if types else out), unused, untyped
