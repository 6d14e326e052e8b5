"""Exact k nearest neighbours without a cross join.

A tree of pivots cuts the points: a cell of more than `block_rows` points is split around pivots of its own, level by level, until every
leaf is one bounded block. A point's own leaf gives an upper bound on its k-th distance; it then walks down the tree and enters only the
children whose ball can hold something closer. Cells, balls and visits are tables, so nothing that grows with the points reaches the
driver. Every task compares a bounded share of a cell's visitors with its pivots or its block, and only the k best per query and leaf
leave the task. Equal points are compared once: one stands for all its copies.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.functions.hashing import key_digest
from creditloom.session import cut_lineage, small_side

# Children of one cell at most, visitors of a cell in one task, and leaves per block that a split aims at (cells differ in size).
FAN = 64
TASK_ROWS = 20_000
LEAVES_PER_BLOCK = 4


def _distances(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Euclidean distances, accumulated by coordinate to keep memory at queries x block."""
    total = np.zeros((len(queries), len(block)))
    for j in range(block.shape[1]):
        total += (queries[:, j, None] - block[None, :, j]) ** 2
    return np.sqrt(total)


def nearest_neighbours(points: DataFrame, k: int, key: str = "SK_ID_CURR", vector: str = "vec", block_rows: int = 2000,
                       seed: int = 42) -> DataFrame:
    """(key, neighbour, neighbour_vec, distance, place 1..k), ties by neighbour key."""
    points = points.select(F.col(key).alias("id"), F.col(vector).alias("vec"))
    # The k + 1 smallest ids of a vector are all that anyone can need of its copies. The rank limit is
    # applied before the shuffle too, so a vector shared by a third of the points stays small.
    smallest = Window.partitionBy("vec").orderBy("id")
    copies = points.withColumn("_r", F.row_number().over(smallest)).filter(F.col("_r") <= k + 1) \
        .groupBy("vec").agg(F.array_sort(F.collect_list("id")).alias("ids")) \
        .select(F.element_at("ids", 1).alias("id"), "vec", "ids").persist(StorageLevel.MEMORY_AND_DISK)
    near = _between_distinct(copies.select("id", "vec"), k, block_rows, seed)
    lists = copies.select(F.col("id").alias("neighbour"), "ids")
    found = near.join(lists, "neighbour").select("id", F.explode("ids").alias("neighbour"), "neighbour_vec", "distance")
    own = copies.select("id", F.explode("ids").alias("neighbour"), F.col("vec").alias("neighbour_vec"), F.lit(0.0).alias("distance"))
    entry = F.struct("distance", "neighbour", "neighbour_vec")
    # At most (k + 1)² entries per vector; one more than k, since a point skips itself.
    best = found.unionByName(own).groupBy("id").agg(F.slice(F.array_sort(F.collect_list(entry)), 1, k + 1).alias("best"))
    per_vector = copies.select("id", "vec").join(best, "id").drop("id")
    mine = F.slice(F.filter("best", lambda e: e["neighbour"] != F.col("id")), 1, k)
    out = points.join(per_vector, "vec").select("id", F.posexplode(mine).alias("pos", "e"))
    return out.select(F.col("id").alias(key), "e.neighbour", "e.neighbour_vec", "e.distance", (F.col("pos") + 1).alias("place"))


def _salted(rows: DataFrame, sizes: DataFrame, per_task: int) -> DataFrame:
    """`rows` (id, cell, ..) with a number `salt` that spreads the rows of a cell over tasks of about `per_task`; `sizes` is (cell, n)."""
    salts = small_side(sizes.select("cell", F.ceil(F.col("n") / per_task).cast("int").alias("salts")))
    return rows.join(salts, "cell").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int")).drop("salts")


def _per_salt(cells: DataFrame, sizes: DataFrame, per_task: int) -> DataFrame:
    """One copy of each row of `cells` for every salt that `_salted` gives its cell."""
    salts = small_side(sizes.select("cell", F.ceil(F.col("n") / per_task).cast("int").alias("salts")))
    out = cells.join(salts, "cell").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    # New names, since the other side of a cogroup may come from the same tables.
    return out.select([F.col(c).alias(f"its_{c}") for c in out.columns])


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))


def pivot_tree(points: DataFrame, block_rows: int, seed: int) -> tuple[DataFrame, list[DataFrame]]:
    """Leaves and balls of the points (id, vec), all vectors different.

    Leaves: (id, vec, cell, parent, n), n <= block_rows points in each cell. Balls, one table per level: (cell, children), a child being
    (cell, n, radius, pivot). Cells are named by their path; the root is the empty text.
    """
    kind = points.schema["id"].dataType.simpleString()
    n = points.count()
    if n <= block_rows:
        return points.select("id", "vec", F.lit("").alias("cell"), F.lit(None).cast("string").alias("parent"), F.lit(n).alias("n")), []

    def assign(rows: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in ("id", "vec", "parent", "child", "reach")})
        d = _distances(np.stack(rows["vec"].to_numpy()), np.stack(cell["its_pivots"].iloc[0]))
        # Vectors whose differences vanish in doubles are dealt out; a ball holds whatever it was given.
        child = d.argmin(1) if d.any() else np.arange(len(d)) % d.shape[1]
        return pd.DataFrame({"id": rows["id"].to_numpy(), "vec": rows["vec"].to_numpy(), "parent": rows["cell"].to_numpy(),
                             "child": child.astype("int32"), "reach": d[np.arange(len(d)), child]})

    inner = points.select("id", "vec", F.lit("").alias("cell"))
    sizes = points.sparkSession.createDataFrame([("", n)], "cell string, n bigint")
    leaves, levels = [], []
    while not sizes.isEmpty():
        # The rank limit works before the shuffle too, so a cell with all points sends FAN rows per task.
        drawn = Window.partitionBy("cell").orderBy(key_digest(F.col("id"), seed), "id")
        wanted = F.least(F.lit(FAN), F.ceil(F.col("n") / block_rows) * LEAVES_PER_BLOCK).cast("int")
        pivots = inner.withColumn("_r", F.row_number().over(drawn)).filter(F.col("_r") <= FAN).groupBy("cell") \
            .agg(F.array_sort(F.collect_list(F.struct("_r", "vec"))).alias("p")).join(sizes, "cell") \
            .select("cell", F.slice(F.col("p.vec"), F.lit(1), wanted).alias("pivots")).persist(StorageLevel.MEMORY_AND_DISK)
        # Both tables of a level are checkpointed: the plan of the next one would hold this one several times over.
        placed = cut_lineage(_salted(inner, sizes, TASK_ROWS).groupBy("cell", "salt") \
            .cogroup(_per_salt(pivots, sizes, TASK_ROWS).groupBy("its_cell", "its_salt")) \
            .applyInPandas(lambda rows, cell: assign(rows, cell), f"id {kind}, vec array<double>, parent string, child int, reach double") \
            .withColumn("cell", F.concat_ws(".", "parent", F.col("child").cast("string"))))
        level = cut_lineage(placed.groupBy("parent", "child", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius")) \
            .join(pivots.withColumnRenamed("cell", "parent"), "parent") \
            .select("parent", "cell", "n", "radius", F.element_at("pivots", F.col("child") + 1).alias("pivot")))
        levels.append(level.groupBy(F.col("parent").alias("cell")).agg(F.collect_list(F.struct("cell", "n", "radius", "pivot")).alias("children")))
        sized = placed.select("id", "vec", "cell", "parent").join(small_side(level.select("cell", "n")), "cell")
        leaves.append(sized.filter(F.col("n") <= block_rows))
        inner = sized.filter(F.col("n") > block_rows).select("id", "vec", "cell")
        sizes = level.filter(F.col("n") > block_rows).select("cell", "n")
    return _union(leaves).select("id", "vec", "cell", "parent", "n"), levels


def visited_leaves(leaves: DataFrame, levels: list[DataFrame], k: int, block_rows: int) -> DataFrame:
    """(id, vec, cell): the leaves that may hold one of the k nearest of a point; its own is always among them."""
    if not levels:
        return leaves.select("id", "vec", "cell")
    kind = leaves.schema["id"].dataType.simpleString()

    def balls(cell: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, list]:
        children = cell["its_children"].iloc[0]
        return np.stack([c["pivot"] for c in children]).astype(float), np.array([c["radius"] for c in children]), list(children)

    def own_bound(f: pd.DataFrame) -> pd.DataFrame:
        x = np.stack(f["vec"].to_numpy())
        bound = np.empty(len(f))
        for i in range(0, len(f), 256):
            # The point itself is one of the k + 1 smallest.
            bound[i:i + 256] = np.partition(_distances(x[i:i + 256], x), k, axis=1)[:, k]
        return f[["id", "vec"]].assign(bound=bound)

    def parent_bound(f: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        if not len(f):
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in ("id", "vec", "bound")})
        pivots, radius, children = balls(cell)
        far = _distances(np.stack(f["vec"].to_numpy()), pivots) + radius
        order = far.argsort(1)
        # The parent holds more than k + 1 points, so some number of its nearest balls does.
        enough = np.array([c["n"] for c in children])[order].cumsum(1) > k
        return f[["id", "vec"]].assign(bound=np.take_along_axis(far, order, 1)[np.arange(len(f)), enough.argmax(1)])

    schema = f"id {kind}, vec array<double>, bound double"
    large = leaves.filter(F.col("n") > k).select("cell", "id", "vec").groupBy("cell").applyInPandas(lambda f: own_bound(f), schema)
    # At most FAN small leaves of k points each per parent.
    small = leaves.filter(F.col("n") <= k).select("parent", "id", "vec").groupBy("parent") \
        .cogroup(_union(levels).select(F.col("cell").alias("its_cell"), F.col("children").alias("its_children")).groupBy("its_cell")).applyInPandas(lambda f, cell: parent_bound(f, cell), schema)

    def enter(f: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
        if not len(f):
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in ("id", "vec", "bound", "cell", "leaf")})
        pivots, radius, children = balls(cell)
        d, bound = _distances(np.stack(f["vec"].to_numpy()), pivots), f["bound"].to_numpy()[:, None]
        row, child = np.nonzero(d - radius <= bound + 1e-12 * (d + radius + bound))
        names, is_leaf = np.array([c["cell"] for c in children], dtype=object), np.array([c["n"] <= block_rows for c in children])
        return f[["id", "vec", "bound"]].iloc[row].assign(cell=names[child], leaf=is_leaf[child])

    walking, found = large.unionByName(small).withColumn("cell", F.lit("")), []
    for level in levels:
        walking = walking if found else cut_lineage(walking)
        sizes = _sizes(walking)
        step = cut_lineage(_salted(walking, sizes, TASK_ROWS).groupBy("cell", "salt").cogroup(_per_salt(level, sizes, TASK_ROWS).groupBy("its_cell", "its_salt")) \
            .applyInPandas(lambda f, cell: enter(f, cell), f"{schema}, cell string, leaf boolean"))
        found.append(step.filter("leaf").select("id", "vec", "cell"))
        walking = step.filter("NOT leaf").drop("leaf")
    return _union(found)


def _between_distinct(points: DataFrame, k: int, block_rows: int, seed: int) -> DataFrame:
    """(id, neighbour, neighbour_vec, distance): the k nearest of each point (id, vec), all vectors different."""
    kind = points.schema["id"].dataType.simpleString()
    block_rows = max(block_rows, k + 1)
    leaves, levels = pivot_tree(points, block_rows, seed)
    visits = visited_leaves(leaves, levels, k, block_rows)
    sizes = _sizes(visits).persist(StorageLevel.MEMORY_AND_DISK)
    queries = _salted(visits, sizes, block_rows)
    targets = _per_salt(leaves.select("id", "vec", "cell"), sizes, block_rows)

    def compare(q: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(b):
            b = b.sort_values("its_id", kind="stable")
            ids, x, qid = b["its_id"].to_numpy(), np.stack(b["its_vec"].to_numpy()), q["id"].to_numpy()
            qx = np.stack(q["vec"].to_numpy())
            for i in range(0, len(q), 256):
                d = _distances(qx[i:i + 256], x)
                d[qid[i:i + 256, None] == ids[None, :]] = np.inf
                best = np.argsort(d, axis=1, kind="stable")[:, :k]
                dist = np.take_along_axis(d, best, 1)
                r, c = np.nonzero(np.isfinite(dist))
                out.append(pd.DataFrame({"id": qid[i + r], "neighbour": ids[best[r, c]],
                                         "neighbour_vec": list(x[best[r, c]]), "distance": dist[r, c]}))
        # Object columns: an empty column of floats cannot become an array.
        empty = pd.DataFrame({c: pd.Series([], dtype=object) for c in ("id", "neighbour", "neighbour_vec", "distance")})
        return pd.concat(out) if any(map(len, out)) else empty

    near = queries.groupBy("cell", "salt").cogroup(targets.groupBy("its_cell", "its_salt")).applyInPandas(
        lambda q, b: compare(q, b), f"id {kind}, neighbour {kind}, neighbour_vec array<double>, distance double")
    order = Window.partitionBy("id").orderBy("distance", "neighbour")
    return near.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= k).drop("_place")
