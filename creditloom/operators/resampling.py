"""Class rebalancing by synthetic minority rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.functions.hashing import digest_unit
from creditloom.operators.neighbours import nearest_neighbours
from creditloom.operators.ordered import digest_rank


def synthetic_minority(df: DataFrame, features: Sequence[str], label: str, key: str = "SK_ID_CURR", k: int = 5,
                       seed: int = 42, block_rows: int = 2000) -> DataFrame:
    """The synthetic rows that bring the minority to parity: (parent, neighbour, copy, label, features).

    Row number r of the minority (md5 order) gets floor or ceil of needed / minority copies; each copy
    lies at a random place on the segment to one of the k nearest minority neighbours. Features must
    be complete and on comparable scales.
    """
    features = list(features)
    counts = {r[label]: r["count"] for r in df.groupBy(label).count().collect()}
    minority = min(counts, key=lambda v: (counts[v], v))
    small, needed = counts[minority], max(counts.values()) - counts[minority]
    if needed and small <= k:
        raise ValueError(f"the minority class {minority} has {small} rows; {k} neighbours need at least {k + 1}")
    points = df.filter(F.col(label) == minority).select(key, F.array(*[F.col(f).cast("double") for f in features]).alias("vec"))
    copies = F.lit(needed // small) + (F.col("rank") <= needed % small).cast("int")
    bases = digest_rank(points.withColumn("_s", F.lit(0)), key, ["_s"], seed).filter(copies > 0) \
        .select(key, "vec", F.explode(F.sequence(F.lit(1), copies)).alias("copy"))
    around = nearest_neighbours(points, k, key, block_rows=block_rows, seed=seed)
    around = around.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", "neighbour", "neighbour_vec"))).alias("near"))
    draw = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}-"), F.col("copy").cast("string")))
    picked = F.element_at("near", (F.floor(digest_unit(F.md5(draw)) * F.size("near")) + 1).cast("int"))
    mixed = bases.join(around, key).withColumn("_p", picked).withColumn("_w", digest_unit(draw))
    return mixed.select(F.col(key).alias("parent"), F.col("_p.neighbour").alias("neighbour"), "copy", F.lit(minority).alias(label), *[
        (F.element_at("vec", j + 1) + F.col("_w") * (F.element_at("_p.neighbour_vec", j + 1) - F.element_at("vec", j + 1))).alias(f)
        for j, f in enumerate(features)])


def smote(df: DataFrame, features: Sequence[str], label: str, key: str = "SK_ID_CURR", k: int = 5, seed: int = 42,
          block_rows: int = 2000) -> DataFrame:
    """Original rows and synthetic ones (their key is NULL), classes at parity: (key, label, features, synthetic)."""
    made = synthetic_minority(df, features, label, key, k, seed, block_rows)
    old = df.select(key, label, *[F.col(f).cast("double").alias(f) for f in features], F.lit(0).alias("synthetic"))
    kind = df.schema[key].dataType
    new = made.select(F.lit(None).cast(kind).alias(key), F.col(label), *features, F.lit(1).alias("synthetic"))
    return old.unionByName(new)
