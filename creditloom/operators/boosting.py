"""Gradient-boosted trees that route NULL, grown leaf by leaf from distributed histograms.

Features are cut into bins once; NULL has a bin of its own. A histogram holds, per leaf, feature and bin, the sums of the gradients and
hessians of the logistic loss and the number of rows: one aggregate that combines map-side, so only bins x features x open leaves reach the
driver, whatever the number of rows. The leaf whose best split gains most is split next, from a queue. For every cut both ways
of sending NULL are tried, and the better one is kept with the split. The histogram of one child comes from a job that
serves many leaves at a time, that of the other by subtraction.

Binned rows lie in memory as blocks of columns (`histograms`), in as many partitions as their number asks for. A tree takes a job for its
root, which also adds the tree before it to the scores, and one a level: the leaves counted ahead have their own best splits and children
counted too, and leaves that are not split any more are told from the histogram they come from.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from creditloom.functions.naming import quoted
from creditloom.operators import histograms
from creditloom.session import scratch_path, scratch_root

NODES = "tree int, node int, feature string, cut double, null_left boolean, left int, right int, value double, gain double, n_rows bigint"


@dataclass(frozen=True)
class Node:
    """A split (x <= cut goes left, NULL where `null_left` says) or, without a feature, a leaf with its part of the score."""

    tree: int
    node: int
    feature: str | None = None
    cut: float | None = None
    null_left: bool | None = None
    left: int | None = None
    right: int | None = None
    value: float | None = None
    gain: float | None = None
    n_rows: int = 0


def _literal(x: float) -> str:
    return f"double('{x!r}')" if math.isfinite(x) else f"double('{'-' if x < 0 else ''}Infinity')"


def tree_sql(nodes: Mapping[int, Node], at: int = 0) -> str:
    """The score of one tree as a SQL expression."""
    n = nodes[at]
    if n.feature is None:
        return _literal(n.value)
    goes = f"coalesce({quoted(n.feature)} <= {_literal(n.cut)}, {'true' if n.null_left else 'false'})"
    return f"CASE WHEN {goes} THEN {tree_sql(nodes, n.left)} ELSE {tree_sql(nodes, n.right)} END"


class TreeModel(Model):
    """Base score and node table. `transform` adds `margin` (log odds) and `probability` (vector)."""

    def __init__(self, features: Sequence[str], base: float, nodes: Sequence[Node]):
        super().__init__()
        self.features, self.base, self.nodes = list(features), base, list(nodes)

    @property
    def trees(self) -> list[dict[int, Node]]:
        out: dict[int, dict[int, Node]] = {}
        for n in self.nodes:
            out.setdefault(n.tree, {})[n.node] = n
        return [out[t] for t in sorted(out)]

    def margin(self) -> Column:
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + F.expr(tree_sql(tree))
        return total

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = 1 / (1 + F.exp(-F.col("margin")))
        return dataset.withColumn("margin", self.margin()).withColumn("probability", array_to_vector(F.array(1 - p, p)))

    @property
    def featureImportances(self):
        """Gain by feature, adding up to 1."""
        gains = dict.fromkeys(self.features, 0.0)
        for n in self.nodes:
            if n.feature is not None:
                gains[n.feature] += n.gain
        total = sum(gains.values()) or 1.0
        return Vectors.dense([gains[f] / total for f in self.features])

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([tuple(vars(n).values()) for n in self.nodes], NODES)

    def write_to(self, spark: SparkSession, path: str) -> None:
        """The base score is the only leaf of tree -1."""
        base = Node(-1, 0, value=self.base)
        spark.createDataFrame([tuple(vars(n).values()) for n in [base, *self.nodes]], NODES).coalesce(1).write.parquet(path)

    @staticmethod
    def read_from(spark: SparkSession, path: str, features: Sequence[str]) -> TreeModel:
        nodes = sorted((Node(**r.asDict()) for r in spark.read.parquet(path).collect()), key=lambda n: (n.tree, n.node))
        return TreeModel(features, nodes[0].value, nodes[1:])


def split_counts(nodes: DataFrame) -> DataFrame:
    """(feature, n_splits, total_gain) from a node table: how often a feature splits, and what it gains."""
    return nodes.where("feature is not null").groupBy("feature").agg(F.count("*").alias("n_splits"), F.sum("gain").alias("total_gain"))


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int = 64) -> dict[str, list[float]]:
    """Up to bins - 1 different values per feature at which a split can cut, from one aggregate."""
    shares = ", ".join(repr(i / bins) for i in range(1, bins))
    row = df.selectExpr(*[f"percentile_approx(double({quoted(f)}), array({shares}), 10000) AS c{i}" for i, f in enumerate(features)]).first()
    return {f: sorted(set(row[i] or [])) for i, f in enumerate(features)}


def write_blocks(rows: DataFrame, features: Sequence[str], cuts: Mapping[str, Sequence[float]], path: str) -> None:
    """Store rows (k: a hash of the key, y, w, features) as blocks (rows, w, wy, block): bins are the number of cuts below a value and one, 0 for NULL."""
    edges = [np.array(cuts[f], float) for f in features]
    kind = histograms.bin_type(max(map(len, edges), default=0))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.zeros((len(edges), len(batch)), kind)
            for j, e in enumerate(edges):
                v = batch[f"x{j}"].to_numpy(float, na_value=np.nan)
                x[j] = np.where(np.isnan(v), 0, np.searchsorted(e, v, side="left") + 1)
            y, w = batch["y"].to_numpy(float), batch["w"].to_numpy(float)
            yield pd.DataFrame({"rows": [len(batch)], "w": [w.sum()], "wy": [(w * y).sum()], "block": [histograms.packed(x, y, w, batch["k"].to_numpy(np.int64))]})

    plain = rows.select("k", "y", F.coalesce("w", F.lit(0.0)).alias("w"), *[F.col(quoted(f)).cast("double").alias(f"x{j}") for j, f in enumerate(features)])
    plain.mapInPandas(run, "rows bigint, w double, wy double, block binary").write.parquet(path)


#: Rows of a task, and bytes of histograms that tasks send to the driver without adding them up first.
ROWS_PER_TASK, DIRECT_BYTES = 100_000, 16 << 20


@dataclass
class Blocks:
    """Binned rows with their scores, and the draw of a tree (see `histograms.sums`)."""

    rdd: RDD
    tasks: int
    draw: tuple[int, int] | None = None

    @staticmethod
    def read(stored: DataFrame, features: Sequence[str], cuts: Mapping[str, Sequence[float]], base: float) -> Blocks:
        """Of what `write_blocks` stored, persisted; all rows start with the score `base`."""
        n, kind = len(features), histograms.bin_type(max((len(cuts[f]) for f in features), default=0))
        rows = stored.select("block").rdd
        tasks = max(1, min(rows.getNumPartitions(), -(-(stored.agg(F.sum("rows")).first()[0] or 0) // ROWS_PER_TASK)))
        blocks = rows.coalesce(tasks).mapPartitions(lambda part: histograms.joined(histograms.unpacked(bytes(r[0]), n, kind, base) for r in part))
        return Blocks(blocks.persist(StorageLevel.MEMORY_AND_DISK), tasks)

    def scored(self, paths: Sequence[tuple], values: Sequence[float]) -> Blocks:
        """With a tree added to the scores, persisted."""
        return Blocks(self.rdd.map(lambda b: histograms.scored(b, paths, values)).persist(StorageLevel.MEMORY_AND_DISK), self.tasks)

    def kept(self, spark: SparkSession) -> None:
        """Have the first job that reads the blocks write them too, so that a lost executor costs few trees."""
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(scratch_root(spark))
        self.rdd.checkpoint()

    def sums(self, paths: Sequence[tuple], n_features: int, width: int) -> np.ndarray:
        """Gradient, hessian and rows by path, feature and bin."""
        draw, n = self.draw, len(paths)
        if self.tasks * n * 3 * n_features * width * 8 <= DIRECT_BYTES:
            return sum(self.rdd.mapPartitions(lambda b: [histograms.sums(b, paths, width, n_features, draw)]).collect(), np.zeros((n, 3, n_features, width)))
        found = self.rdd.mapPartitions(lambda b: enumerate(histograms.sums(b, paths, width, n_features, draw)))
        by_path = dict(found.reduceByKey(np.add, min(n, self.tasks)).collect())
        return np.stack([by_path[i] for i in range(n)])


@dataclass(eq=False)
class _Leaf:
    """A node under construction: the path to it, its sums and histogram (gradient, hessian, rows; bin 0 is NULL), its best split and what that gives."""

    path: tuple
    total: np.ndarray
    sums: np.ndarray | None
    split: tuple | None = None
    children: tuple[_Leaf, _Leaf] | None = None


def split_gains(sums: np.ndarray, n_cuts: Sequence[int], l2: float, min_rows: int, min_hessian: float) -> tuple[np.ndarray, np.ndarray]:
    """Gain of every (feature, cut, NULL left or right), and the sums on the left; -inf where a side is too small.

    The cut after the last one parts known values from NULL.
    """
    whole = sums[:, 0].sum(axis=1)  # every feature holds all rows
    left = np.cumsum(sums[:, :, 1:], axis=2)
    left = np.stack([left + sums[:, :, :1], left], axis=3)  # NULL left, NULL right
    right = whole[:, None, None, None] - left
    gain = left[0] ** 2 / (left[1] + l2) + right[0] ** 2 / (right[1] + l2) - whole[0] ** 2 / (whole[1] + l2)
    ok = (left[2] >= min_rows) & (right[2] >= min_rows) & (left[1] >= min_hessian) & (right[1] >= min_hessian)
    for j, n in enumerate(n_cuts):
        ok[j, n + 1:] = False
    return np.where(ok, gain, -np.inf), left


def _best(gain: np.ndarray, allowed: np.ndarray, min_gain: float) -> tuple | None:
    """The split of greatest gain; ties (nine digits) go to the first feature, the smallest cut, NULL left."""
    gain = np.where(allowed[:, None, None], gain, -np.inf)
    top = gain.max()
    if not np.isfinite(top) or top <= max(min_gain, 1e-12):
        return None
    j, cut, side = np.argwhere(gain >= top - 1e-9 * abs(top))[0]
    return float(top), int(j), int(cut), side == 0


@dataclass
class NullRoutingTrees(Estimator):
    """Fits a `TreeModel` to a 0/1 label.

    `max_leaves` bounds a tree, `max_depth` its depth; `subsample` draws rows anew for each tree by a hash of `key`, `feature_share`
    the features that a tree may use; rows with label 1 weigh `positive_weight` times. `cuts` gives the cut points, else
    they are quantiles. Values that are NULL, NaN included, follow the split's own direction; where a node has no NULL, they go left.
    Rows without a label are left out.
    """

    features: Sequence[str]
    label: str = "TARGET"
    key: str = "SK_ID_CURR"
    weight: str | None = None
    trees: int = 20
    rate: float = 0.1
    max_leaves: int = 31
    max_depth: int = 6
    l2: float = 1.0
    min_rows: int = 20
    min_hessian: float = 1e-3
    min_gain: float = 0.0
    bins: int = 64
    subsample: float = 1.0
    feature_share: float = 1.0
    positive_weight: float = 1.0
    seed: int = 42
    cuts: Mapping[str, Sequence[float]] | None = None
    leaves_per_job: int = 32
    uid: str = field(default="NullRoutingTrees", repr=False)

    def __post_init__(self) -> None:
        names = vars(self).copy()
        super().__init__()
        vars(self).update({n: v for n, v in names.items() if n != "uid"})

    def _fit(self, dataset: DataFrame) -> TreeModel:
        spark, features = dataset.sparkSession, list(self.features)
        y = F.col(quoted(self.label)).cast("double")
        w = (F.col(quoted(self.weight)).cast("double") if self.weight else F.lit(1.0)) * F.when(y == 1, float(self.positive_weight)).otherwise(1.0)
        known = dataset.where(y.isNotNull()).select(F.col(quoted(self.key)).alias("k"), y.alias("y"), w.alias("w"), *[F.col(quoted(f)).alias(f) for f in features])
        cuts = self.cuts or quantile_cuts(known, features, self.bins)
        n_cuts = [len(cuts[f]) for f in features]
        path = scratch_path(spark, "boosting-bins")
        write_blocks(known.withColumn("k", F.xxhash64("k", F.lit(self.seed))), features, cuts, path)
        stored = spark.read.parquet(path)
        facts = stored.agg(F.sum("wy").alias("p"), F.sum("w").alias("n")).first()
        if not facts["n"] or not 0 < facts["p"] < facts["n"]:
            share = min(max((facts["p"] or 0.0) / (facts["n"] or 1.0), 1e-6), 1 - 1e-6)
            return TreeModel(features, math.log(share / (1 - share)), [])
        base = math.log(facts["p"] / (facts["n"] - facts["p"]))
        rng = np.random.default_rng(self.seed)
        nodes: list[Node] = []
        blocks, before = Blocks.read(stored, features, cuts, base), None
        for t in range(self.trees):
            allowed = np.zeros(len(features), bool)
            allowed[rng.choice(len(features), max(1, round(self.feature_share * len(features))), replace=False)] = True
            blocks.draw = (t, int(self.subsample * (1 << 20))) if self.subsample < 1 else None
            tree, paths, values = self._grow(blocks, features, cuts, n_cuts, allowed, t)
            if before is not None:
                before.rdd.unpersist()
            nodes += tree
            if len(tree) < 2:
                break
            if t + 1 < self.trees:
                blocks, before = blocks.scored(paths, values), blocks
                if t % 10 == 9:
                    blocks.kept(spark)
        blocks.rdd.unpersist()
        return TreeModel(features, base, nodes)

    def _histograms(self, graded: Blocks, wanted: Sequence[tuple[int, tuple]], n_features: int, width: int) -> dict[int, np.ndarray]:
        """Sums per leaf (number, path): array of gradient, hessian and rows by feature and bin."""
        return dict(zip([i for i, _ in wanted], graded.sums([path for _, path in wanted], n_features, width)))

    def _grow(self, graded: Blocks, features: list[str], cuts, n_cuts: list[int], allowed: np.ndarray, tree: int) -> tuple[list[Node], list[tuple], list[float]]:
        """The nodes of a tree; paths and values of its leaves."""
        width = max(n_cuts, default=0) + 2
        waiting: list[_Leaf] = []  # leaves that may be split, also of splits not made yet, whose children are not counted

        def leaf_of(path: tuple, sums: np.ndarray | None, total: np.ndarray | None = None) -> _Leaf:
            leaf = _Leaf(path, sums[:, 0].sum(axis=1) if total is None else total, sums)
            if sums is not None:
                gain, _ = split_gains(sums, n_cuts, self.l2, self.min_rows, self.min_hessian)
                leaf.split = _best(gain, allowed, self.min_gain) if len(path) < self.max_depth else None
                if leaf.split and len(path) + 1 < self.max_depth:
                    waiting.append(leaf)
            return leaf

        def count(leaf: _Leaf) -> None:
            """The children of the leaf, and of the most promising others with it, by one job."""
            ahead = [leaf, *heapq.nsmallest(self.leaves_per_job - 1, (a for a in waiting if a is not leaf), key=lambda a: -a.split[0])]
            waiting[:] = [a for a in waiting if not any(a is b for b in ahead)]
            lefts = self._histograms(graded, [(i, (*a.path, (*a.split[1:], True))) for i, a in enumerate(ahead)], len(features), width)
            for i, a in enumerate(ahead):
                a.children = leaf_of((*a.path, (*a.split[1:], True)), lefts[i]), leaf_of((*a.path, (*a.split[1:], False)), a.sums - lefts[i])

        def told(leaf: _Leaf) -> None:
            """Its children, which are not split any more, from its own histogram."""
            _, j, cut, null_left = leaf.split
            left = leaf.sums[:, j, 0 if null_left else 1:cut + 2].sum(axis=1)
            leaf.children = leaf_of((*leaf.path, (*leaf.split[1:], True)), None, left), leaf_of((*leaf.path, (*leaf.split[1:], False)), None, leaf.total - left)

        root = leaf_of((), self._histograms(graded, [(0, ())], len(features), width)[0])
        queue: list[tuple] = [(-root.split[0], 0)] if root.split else []
        splits: dict[int, tuple] = {}
        leaves, numbers = {0: root}, 1
        while queue and len(leaves) < self.max_leaves:
            _, number = heapq.heappop(queue)
            leaf = leaves.pop(number)
            if leaf.children is None:
                if len(leaf.path) + 1 >= self.max_depth or len(leaves) + 2 >= self.max_leaves:
                    told(leaf)
                else:
                    count(leaf)
            splits[number] = (leaf, numbers, numbers + 1)
            for child in leaf.children:
                leaves[numbers] = child
                if child.split:
                    heapq.heappush(queue, (-child.split[0], numbers))
                numbers += 1

        nodes = []
        for number, (leaf, left, right) in splits.items():
            gain, j, cut, null_left = leaf.split
            edge = float(cuts[features[j]][cut]) if cut < n_cuts[j] else math.inf
            nodes.append(Node(tree, number, features[j], edge, bool(null_left), left, right, None, gain, round(leaf.total[2])))
        for number, leaf in leaves.items():
            g, h, n = leaf.total
            nodes.append(Node(tree, number, value=float(-self.rate * g / (h + self.l2)), n_rows=round(n)))
        values = {n.node: n.value for n in nodes if n.feature is None}
        return sorted(nodes, key=lambda n: n.node), [leaf.path for leaf in leaves.values()], [values[number] for number in leaves]


def routed_trees(features: Sequence[str], params: Mapping[str, float] | None = None, **fixed) -> Pipeline:
    """A pipeline of `NullRoutingTrees` with the parameters of a trial, by the names of the tree space of a search."""
    names = {"max_iter": ("trees", int), "step_size": ("rate", float), "max_depth": ("max_depth", int), "subsample": ("subsample", float), "min_rows": ("min_rows", int),
             "min_gain": ("min_gain", float), "feature_share": ("feature_share", float), "positive_weight": ("positive_weight", float)}
    drawn = {names[n][0]: names[n][1](v) for n, v in (params or {}).items() if n in names}
    return Pipeline(stages=[NullRoutingTrees(features, **{**drawn, **fixed})])
