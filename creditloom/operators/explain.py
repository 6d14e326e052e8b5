"""Additive contributions (Shapley values) and the views built from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creditloom.functions.hashing import digest_unit


def linear_contributions(df: DataFrame, coefficients: Mapping[str, float], means: Mapping[str, float],
                         keep: Sequence[str] = ("SK_ID_CURR",)) -> DataFrame:
    """Closed form for a linear score: coef * (x - mean), one column per feature, no shuffle."""
    return df.select(*keep, *[(F.lit(float(b)) * (F.col(c) - F.lit(float(means[c])))).alias(c) for c, b in coefficients.items()])


def feature_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    return df.agg(*[F.avg(c).alias(c) for c in features]).first().asDict()


def contribution_list(features: Sequence[str], descending: bool = True) -> Column:
    """The row's contributions as an array ordered by size, ties by name.

    Built inside the row: ranking a client's features needs no shuffle and no window.
    """
    cells = F.array(*[F.struct((-F.abs(F.col(f))).alias("o"), F.lit(f).alias("feature"), F.col(f).alias("contribution"))
                      for f in features])
    return F.array_sort(cells) if descending else F.reverse(F.array_sort(cells))


def local_top(contributions: DataFrame, features: Sequence[str], k: int, key: str = "SK_ID_CURR") -> DataFrame:
    """(key, rank, feature, contribution, direction) of each client's k strongest features."""
    listed = contributions.select(key, F.posexplode(F.slice(contribution_list(features), 1, k)).alias("pos", "c"))
    side = F.when(F.col("c.contribution") > 0, "risk").otherwise("safe")
    return listed.select(key, (F.col("pos") + 1).alias("rank"), "c.feature", "c.contribution", side.alias("direction"))


def global_importance(contributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, importance, signed_mean): mean absolute and mean contribution, one aggregate."""
    wide = contributions.agg(*[F.struct(F.lit(f).alias("feature"), F.avg(F.abs(F.col(f))).alias("importance"),
                                        F.avg(F.col(f)).alias("signed_mean")).alias(f"_{i}") for i, f in enumerate(features)])
    return wide.select(F.explode(F.array(*[F.col(f"_{i}") for i in range(len(features))])).alias("r")).select("r.*")


def additivity(contributions: DataFrame, features: Sequence[str], base: Column, output: str) -> DataFrame:
    """(n, max_residual, mean_residual) of base + sum of contributions against the model output."""
    total = base
    for f in features:
        total = total + F.col(f)
    gap = F.abs(total - F.col(output))
    return contributions.agg(F.count(F.lit(1)).alias("n"), F.max(gap).alias("max_residual"), F.avg(gap).alias("mean_residual"))


def main_features(contributions: DataFrame, features: Sequence[str], global_top: Sequence[str], k: int,
                  fixed: Sequence[str] = ("PROBA", "PREDICTION"), key: str = "SK_ID_CURR") -> DataFrame:
    """(key, feature) per client: its own top k, then the global top k, then fixed names, each once, by name."""
    own = F.transform(F.slice(contribution_list(features), 1, k), lambda c: c["feature"])
    rest = F.array(*[F.lit(f) for f in [*list(global_top)[:k], *fixed]])
    names = F.array_sort(F.array_distinct(F.concat(own, rest)))
    return contributions.select(key, F.posexplode(names).alias("pos", "feature"))


def exact_shapley(df: DataFrame, players: Sequence[str], value: Callable[[frozenset], Column],
                  keep: Sequence[str] = ("SK_ID_CURR",)) -> DataFrame:
    """Shapley values by enumerating coalitions, for at most 10 players.

    `value(S)` is the model output when only the players in S are known. All 2^n values are columns
    of the row, so the whole computation is a projection.
    """
    n = len(players)
    if n > 10:
        raise ValueError("more than 10 players: use sampled_shapley")
    names = {}
    coalition_columns = []
    for mask in range(2 ** n):
        members = frozenset(p for i, p in enumerate(players) if mask >> i & 1)
        names[members] = f"_s{mask}"
        coalition_columns.append(value(members).alias(f"_s{mask}"))
    valued = df.select(*keep, *coalition_columns)

    def phi(player: str) -> Column:
        total = F.lit(0.0)
        for members, name in names.items():
            if player in members:
                continue
            s = len(members)
            weight = factorial(s) * factorial(n - s - 1) / factorial(n)
            total = total + F.lit(weight) * (F.col(names[members | {player}]) - F.col(name))
        return total

    return valued.select(*keep, F.col(names[frozenset()]).alias("base_value"), *[phi(p).alias(p) for p in players],
                         F.col(names[frozenset(players)]).alias("output"))


def sampled_shapley(df: DataFrame, features: Sequence[str], background: Sequence[Mapping[str, float]],
                    predict: Callable[[DataFrame], DataFrame], permutations: int = 8, seed: int = 42,
                    key: str = "SK_ID_CURR") -> DataFrame:
    """Permutation-sampling Shapley values of any model: (key, feature, contribution, std_error).

    `predict` maps a frame with the feature columns to the same frame plus a double column `PROBA`.
    `background` is a bounded sample of reference rows (it becomes a literal). Each (row, permutation)
    draws one reference row and walks from it to the client's own values one feature at a time; the
    walk's p + 1 rows are scored by the model in one distributed pass. Draws come from md5 of the key.
    """
    features = list(features)
    p = len(features)
    reference = F.array(*[F.array(*[F.lit(None if b[f] is None else float(b[f])).cast("double") for f in features]) for b in background])
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}-"), F.col("_perm").cast("string")))
    order = F.array_sort(F.transform(
        F.sequence(F.lit(0), F.lit(p - 1)),
        lambda j: F.struct(F.md5(F.concat(F.col("_draw"), F.lit("-"), j.cast("string"))).alias("h"), j.alias("j"))))
    walked = (
        df.select(key, F.array(*[F.col(f).cast("double") for f in features]).alias("_x"),
                  F.explode(F.sequence(F.lit(1), F.lit(permutations))).alias("_perm"))
        .withColumn("_draw", draw)
        .withColumn("_ref", F.element_at(reference, (F.floor(digest_unit(F.col("_draw")) * len(background)) + 1).cast("int")))
        .withColumn("_order", F.transform(order, lambda e: e["j"]))
        .withColumn("_t", F.explode(F.sequence(F.lit(0), F.lit(p))))
    )
    # Place of feature j in the order, 1-based: known once _t reaches it.
    mixed = walked.select(key, "_perm", "_t", "_order", *[
        F.when(F.array_position("_order", j) <= F.col("_t"), F.element_at("_x", j + 1))
        .otherwise(F.element_at("_ref", j + 1)).alias(f) for j, f in enumerate(features)])
    scored = predict(mixed).select(key, "_perm", "_t", "_order", F.col("PROBA").alias("_y"))
    # Step t adds feature order[t]: +y_t for it, and -y_t for the feature of step t + 1.
    gains = scored.select(key, "_perm", F.explode(F.array(
        F.struct(F.when(F.col("_t") > 0, F.try_element_at("_order", F.greatest(F.col("_t"), F.lit(1)))).alias("j"), F.col("_y").alias("g")),
        F.struct(F.when(F.col("_t") < p, F.try_element_at("_order", F.least(F.col("_t") + 1, F.lit(p)))).alias("j"), (-F.col("_y")).alias("g")),
    )).alias("c")).filter("c.j is not null")
    per_walk = gains.groupBy(key, F.col("c.j").alias("_j"), "_perm").agg(F.sum("c.g").alias("_d"))
    names = F.array(*[F.lit(f) for f in features])
    return per_walk.groupBy(key, "_j").agg(
        F.avg("_d").alias("contribution"), (F.stddev_samp("_d") / F.sqrt(F.lit(float(permutations)))).alias("std_error")
    ).select(key, F.element_at(names, F.col("_j").cast("int") + 1).alias("feature"), "contribution", "std_error")


def background_rows(df: DataFrame, features: Sequence[str], n: int = 50, seed: int = 42, key: str = "SK_ID_CURR") -> list[dict]:
    """n reference rows in md5 order of the key: a bounded sample for `sampled_shapley`. Missing values stay missing, for the model
    to impute; only rows without any value are left out."""
    from creditloom.functions.hashing import key_digest

    rows = df.select(key, *features).dropna(how="all", subset=list(features)).orderBy(key_digest(F.col(key), seed), key).limit(n).collect()
    return [{f: None if r[f] is None else float(r[f]) for f in features} for r in rows]
