"""Approximate nearest neighbours by learned partitions of a neighbour graph.

1. On a bounded sample (`SAMPLE` vectors, chosen by a hash of the id) the graph of nearest neighbours is computed exactly and cut into parts
   of equal size: from median splits, pairs of nodes that both gain neighbours trade places until hardly any edge more is saved.
2. A small network learns where the neighbours of a vector lie: its targets are the shares of a node's neighbours by part.
3. Every row is indexed in its most probable part. A query goes to its most probable parts, until their probabilities add up to
   a mass that on sampled queries, kept from training, finds `target_recall` of the true neighbours, and until the parts hold enough rows.
4. Every candidate in the visited parts is compared exactly, in blocks: points lie still, queries stream past them.

All rows are indexed and compared, the sample only shapes the parts. Copies of a vector are one point with its smallest ids, and equal
queries are searched once. A part that grows is cut into more blocks, and a block with many queries is worked on by several
tasks; no candidate is dropped.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from creditloom.llm.common import stored

SAMPLE = 20_000
PART_ROWS, MOST_PARTS = 250, 128
BLOCK_ROWS, CHUNK_QUERIES = 4_096, 20_000
RECALL = 0.93
CELLS = 1 << 20  # numbers of a matrix that is worked on at once while the sample is learned from, 8 MB


def near_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the k nearest rows of each row, itself left out."""
    out, norms, step = np.empty((len(x), k), np.int32), (x * x).sum(axis=1), max(1, CELLS // len(x))
    for i in range(0, len(x), step):
        d = x[i:i + step] @ x.T
        d *= -2
        d += norms[None, :]
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        out[i:i + step] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def median_splits(x: np.ndarray, parts: int) -> np.ndarray:
    """Parts of equal size, at most one row apart: cut across the direction of the largest spread, again and again."""
    part = np.zeros(len(x), np.int32)
    todo = [(np.arange(len(x)), 0, parts)]
    while todo:
        rows, first, n = todo.pop()
        part[rows] = first
        if n > 1:
            centred = x[rows] - x[rows].mean(axis=0)
            direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
            order, left = rows[np.argsort(centred @ direction, kind="stable")], n // 2
            cut = len(rows) * left // n
            todo += [(order[:cut], first, left), (order[cut:], first + left, n - left)]
    return part


def balanced_parts(graph: np.ndarray, part: np.ndarray, parts: int, rounds: int = 30) -> np.ndarray:
    """Equal-sized parts with fewer cut edges: nodes of two parts trade places while both together gain neighbours."""
    part, n = part.copy(), len(part)
    ends = np.repeat(np.arange(n), graph.shape[1]), graph.ravel()
    rng = np.random.default_rng(11)
    for _ in range(rounds):
        beside = np.zeros((n, parts), np.int32)
        np.add.at(beside, (ends[0], part[ends[1]]), 1)
        np.add.at(beside, (ends[1], part[ends[0]]), 1)
        gain = beside - beside[np.arange(n), part][:, None]
        gain[np.arange(n), part] = -1 << 20
        wish = gain.argmax(axis=1)
        best = gain[np.arange(n), wish]
        # A node's wish counts in half of the rounds, so that neighbours don't swap past each other.
        movers = np.flatnonzero((best > 0) & (rng.random(n) < 0.5))
        movers = movers[np.argsort(-best[movers], kind="stable")]
        route = part[movers] * parts + wish[movers]
        queues = {int(r): movers[route == r] for r in np.unique(route)}
        moved = 0
        for r, there in queues.items():
            a, b = divmod(r, parts)
            back = queues.get(b * parts + a)
            if a < b and back is not None:
                m = min(len(there), len(back))
                part[there[:m]], part[back[:m]] = b, a
                moved += 2 * m
        if moved < n / 2000:
            break
    return part


@dataclasses.dataclass(frozen=True)
class Router:
    """One hidden layer; rows to the probabilities of the parts."""

    mean: np.ndarray
    scale: float
    inner: np.ndarray
    outer: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out, step = np.empty((len(x), self.outer.shape[1])), max(1, CELLS // max(self.inner.shape + self.outer.shape))
        for i in range(0, len(x), step):
            out[i:i + step] = _softmax(_ones(np.maximum(_ones((x[i:i + step] - self.mean) / self.scale) @ self.inner, 0)) @ self.outer)
        return out


def _ones(x: np.ndarray) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))])


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train_router(x: np.ndarray, targets: np.ndarray, hidden: int = 128, epochs: int = 25, batch: int = 256, rate: float = 2e-3) -> Router:
    """Cross-entropy against the shares of neighbours by part; Adam over shuffled batches."""
    rng = np.random.default_rng(5)
    mean, scale = x.mean(axis=0), float(x.std() + 1e-12)
    z = _ones((x - mean) / scale)
    weights = [rng.normal(0, np.sqrt(2 / z.shape[1]), (z.shape[1], hidden)), rng.normal(0, np.sqrt(1 / hidden), (hidden + 1, targets.shape[1]))]
    first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for i in range(0, len(z), batch):
            rows = order[i:i + batch]
            layer = _ones(np.maximum(z[rows] @ weights[0], 0))
            error = (_softmax(layer @ weights[1]) - targets[rows]) / len(rows)
            back = (error @ weights[1][:-1].T) * (layer[:, :-1] > 0)
            t += 1
            for j, g in enumerate((z[rows].T @ back + 1e-5 * weights[0], layer.T @ error + 1e-5 * weights[1])):
                first[j], second[j] = 0.9 * first[j] + 0.1 * g, 0.999 * second[j] + 0.001 * g * g
                weights[j] = weights[j] - rate * (first[j] / (1 - 0.9**t)) / (np.sqrt(second[j] / (1 - 0.999**t)) + 1e-8)
    return Router(mean, scale, weights[0], weights[1])


def visited(p: np.ndarray, mass: float, sizes: np.ndarray, least: int) -> np.ndarray:
    """Which parts each row of probabilities visits: the most probable ones up to `mass`, and on until they hold `least` rows."""
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, 1), axis=1) - np.take_along_axis(p, order, 1)
    rows_before = np.cumsum(sizes[order], axis=1) - sizes[order]
    out = np.zeros(p.shape, bool)
    np.put_along_axis(out, order, (before < mass) | (rows_before < least), 1)
    return out


@dataclasses.dataclass(frozen=True)
class Index:
    router: Router | None
    parts: int
    mass: float

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self.router.probabilities(x) if self.router else np.ones((len(x), 1))


def learn(x: np.ndarray, parts: int, k: int, target_recall: float = RECALL) -> Index:
    """Parts, router and probability mass from sampled vectors. A tenth of them, not trained on, are the queries that set the mass."""
    if parts < 2 or len(x) < 20 * parts:
        return Index(None, 1, 1.0)
    graph = near_graph(x, k)
    part = balanced_parts(graph, median_splits(x, parts), parts)
    targets = np.zeros((len(x), parts))
    np.add.at(targets, (np.repeat(np.arange(len(x)), k), part[graph.ravel()]), 1 / k)
    tested = np.arange(len(x)) % 10 == 0
    router = train_router(x[~tested], targets[~tested])
    p = router.probabilities(x)
    home, sizes = p.argmax(axis=1), np.bincount(p.argmax(axis=1), minlength=parts)
    for mass in (0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.84, 0.88, 0.9, 0.92, 0.94, 0.96, 0.98):
        seen = visited(p[tested], mass, sizes, k + 1)
        if np.take_along_axis(seen, home[graph[tested]], 1).mean() >= target_recall:
            return Index(router, parts, mass)
    return Index(router, parts, 2.0)  # every part


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vec): rows that take part. Where keys repeat, the smallest vector of a key stands for it."""
    vec = F.col(f"`{vector}`")
    fit = F.col(f"`{key}`").isNotNull() & (F.size(vec) > 0) & ~F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(vec, lambda v: v != 0)
    rows = vectors.where(F.coalesce(fit, F.lit(False))).select(F.col(f"`{key}`").alias("id"), vec.alias("vec"))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    rows = rows.where(F.size("vec") == (sizes[0]["n"] if sizes else 0))
    facts = rows.agg(F.count("id").alias("n"), F.countDistinct("id").alias("d")).first()
    return rows if facts["n"] == facts["d"] else rows.groupBy("id").agg(F.min("vec").alias("vec"))


def drawn(points: DataFrame, n: int, sample: int) -> np.ndarray:
    """At most `sample` of n points (ids, vec): those whose smallest ids have the smallest hashes.

    A limit lets every task send `sample` rows, so tasks first leave out hashes that can hardly be among them; a few rows more than
    `sample` go to the driver in all, however many tasks there are. They come as Arrow batches, without an object per number.
    """
    rows, share = points.select(F.element_at("ids", 1).alias("id"), F.col("vec").cast("array<double>").alias("vec")), (1.1 * sample + 1000) / max(n, 1)
    if share < 1:
        rows = rows.where(F.xxhash64("id") < F.lit(int((share - 0.5) * 2**64)))
    vec = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("vec").toArrow()["vec"].combine_chunks()
    return vec.flatten().to_numpy().reshape(len(vec), -1) if len(vec) else np.zeros((0, 0))


def nearest(vectors: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", every: int = 100, sample: int = SAMPLE,
            part_rows: int = PART_ROWS, target_recall: float = RECALL, block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES) -> DataFrame:
    """(query_id, rank from 1, `key`, score): the k nearest rows found for every row whose key is divisible by `every`.

    Euclidean distance in double precision on the vectors as given; ties go to the smaller key; a row is not its own neighbour, its copies
    under other keys are. Vectors that are null, zero or hold a null or non-finite number take no part, nor do rows without key, nor
    vectors that are not as long as most (of lengths equally frequent, the shorter one counts). Equal rows count once, of different vectors
    under one key the smallest counts. With fewer than k candidates all are returned. An empty table gives an empty result.
    """
    points = stored(usable(vectors, key, vector), "ann-rows")
    kind = points.schema["id"].dataType.simpleString()
    # The k + 1 smallest ids of a vector are all that anyone can need of its copies; the limit is applied before the shuffle too.
    smallest = Window.partitionBy("vec").orderBy("id")
    distinct = stored(points.withColumn("r", F.row_number().over(smallest)).where(F.col("r") <= k + 1).groupBy("vec")
                      .agg(F.array_sort(F.collect_list("id")).alias("ids")), "ann-points")
    n = distinct.count()
    index = learn(drawn(distinct, n, sample), min(MOST_PARTS, -(-n // part_rows)), k, target_recall)
    model = vectors.sparkSession.sparkContext.broadcast(index)
    vec_type = points.schema["vec"].dataType.simpleString()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(part=model.value.probabilities(np.stack(batch["vec"]).astype(float)).argmax(axis=1).astype(np.int32))

    placed = stored(distinct.mapInPandas(place, f"vec {vec_type}, ids array<{kind}>, part int"), "ann-index")
    sizes = np.zeros(index.parts, np.int64)
    for r in placed.groupBy("part").count().collect():  # at most MOST_PARTS rows
        sizes[r["part"]] = r["count"]

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                seen = visited(model.value.probabilities(np.stack(batch["vec"]).astype(float)), index.mass, sizes, k + 1)
                yield batch.assign(parts=[np.flatnonzero(s).astype(np.int32) for s in seen])

    asked = points.where(F.pmod("id", F.lit(every)) == 0)
    questions = asked.groupBy("vec").agg(F.min("id").alias("q")).mapInPandas(route, f"vec {vec_type}, q {kind}, parts array<int>")
    questions = stored(questions.withColumn("part", F.explode("parts")).drop("parts"), "ann-questions")
    busy = {r["part"]: r["count"] for r in questions.groupBy("part").count().collect()}
    blocks = F.element_at(F.lit([max(1, -(-int(s) // block_rows)) for s in sizes]), F.col("part") + 1)
    chunks = F.element_at(F.lit([max(1, -(-busy.get(p, 0) // chunk_queries)) for p in range(index.parts)]), F.col("part") + 1)
    laid = placed.select("part", F.pmod(F.xxhash64(F.element_at("ids", 1)), blocks).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"),
                         F.lit(0).alias("kind"), F.lit(None).cast(kind).alias("q"), "ids", "vec")
    sent = questions.select("part", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.pmod(F.xxhash64("q", F.lit(1)), chunks).cast("int").alias("chunk"),
                            F.lit(1).alias("kind"), "q", F.lit(None).cast(f"array<{kind}>").alias("ids"), "vec")
    desk = ["part", "block", "chunk"]
    best = (laid.unionByName(sent).repartition(*desk).sortWithinPartitions(*desk, "kind")
            .mapInPandas(_compare(k + 1), f"q {kind}, id {kind}, score double"))
    order = Window.partitionBy("q").orderBy("score", "id")
    lists = (best.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).groupBy("q").agg(F.array_sort(F.collect_list(F.struct("score", "id"))).alias("found"))
             .join(questions.select("q", "vec").distinct(), "q"))
    own = asked.join(lists.drop("q"), "vec").select("id", F.slice(F.filter("found", lambda e: e["id"] != F.col("id")), 1, k).alias("found"))
    return own.select(F.col("id").alias("query_id"), F.posexplode("found").alias("at", "e")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("e.id").alias(key), F.col("e.score").alias("score"))


def _compare(k: int):
    """Rows sorted by desk and kind (points, then queries) to the k best (q, id, score) per query and desk. Memory: one block and one batch."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        desk, held, block = None, [], None
        for batch in batches:
            keys = list(zip(*[batch[c].tolist() for c in ("part", "block", "chunk", "kind")], strict=True))
            for (*here, kind), rows in groupby(range(len(batch)), key=keys.__getitem__):
                rows = list(rows)
                if here != desk:
                    desk, held, block = here, [], None
                some = batch.iloc[rows]
                if kind == 0:
                    held.append((np.stack(some["vec"]).astype(float), some["ids"].tolist()))
                    continue
                if block is None and held:
                    block = np.vstack([h[0] for h in held]), [i for h in held for i in h[1]]
                if block is not None:
                    x = np.stack(some["vec"]).astype(float)
                    for i in range(0, len(x), 256):
                        yield _best(some["q"].tolist()[i:i + 256], x[i:i + 256], *block, k)
    return run


def _best(names: list, queries: np.ndarray, points: np.ndarray, ids: list, k: int) -> pd.DataFrame:
    """The k best ids per query. A matrix product picks what may be among them, with room for its rounding; those are measured exactly."""
    near = (queries * queries).sum(axis=1)[:, None] - 2 * (queries @ points.T) + (points * points).sum(axis=1)[None, :]
    m = min(k, len(points))
    reach = np.partition(near, m - 1, axis=1)[:, m - 1]
    room = 1e-9 * (np.abs(reach) + (queries * queries).sum(axis=1) + (points * points).sum(axis=1).max())
    out = []
    for i, name in enumerate(names):
        kept = np.flatnonzero(near[i] <= reach[i] + room[i])
        total = np.zeros(len(kept))
        for j in range(points.shape[1]):
            total += (points[kept, j] - queries[i, j]) ** 2
        found = sorted((d, one) for d, at in zip(np.sqrt(total).tolist(), kept.tolist(), strict=True) for one in ids[at])[:k]
        out += [(name, one, d) for d, one in found]
    return pd.DataFrame(out, columns=["q", "id", "score"])
