from functools import reduce
from operator import add

import numpy as np
import pytest

from creditloom.llm import nearest


def brute(rows, k, every):
    """Per query the k nearest (id, distance), exactly."""
    rows = {i: v for i, v in sorted(((i, v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)), key=lambda r: (r[0], [-x for x in r[1]]))}
    ids = np.array(sorted(rows))
    x = np.array([rows[i] for i in ids], float)
    out = {}
    for q in ids[ids % every == 0]:
        total = np.zeros(len(ids))
        for j in range(x.shape[1]):
            total += (x[:, j] - rows[q][j]) ** 2
        order = sorted((d, i) for d, i in zip(np.sqrt(total).tolist(), ids.tolist()) if i != q)[:k]
        out[int(q)] = [(i, d) for d, i in order]
    return out


def lists(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert all([a for a, _, _ in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [(i, d) for _, i, d in v] for q, v in out.items()}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_on_the_tables(spark, folder):
    frame = spark.read.parquet(f"{folder}/embeddings.parquet")
    got, want = lists(nearest.nearest(frame, block_rows=100)), brute([(r.vec_id, r.embedding) for r in frame.collect()], 10, 100)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items()) / sum(map(len, want.values()))
    assert hits >= 0.9 and got.keys() == want.keys() and all(len(v) == 10 and v == sorted(v, key=lambda e: (e[1], e[0])) for v in got.values())


def test_clusters_need_few_parts_and_scores_are_exact(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(24, 16)) * 4
    x = (centres[rng.integers(0, 24, 6000)] + rng.normal(size=(6000, 16)))
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got, want = lists(nearest.nearest(frame, block_rows=300, chunk_queries=20)), brute(rows, 10, 100)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in w}) for q, w in want.items()) / 600
    assert hits >= 0.9
    exact = {q: {i: float(np.sqrt(reduce(add, ((a - b) * (a - b) for a, b in zip(rows[q][1], rows[i][1]))))) for i, _ in v} for q, v in got.items()}
    assert all(d == exact[q][i] for q, v in got.items() for i, d in v)
    index = nearest.learn(x, 24, 10)
    assert index.parts == 24 and nearest.visited(index.probabilities(x[:500]), index.mass, np.full(24, 250), 11).sum(axis=1).mean() < 6


def test_parts_are_balanced_and_cut_fewer_edges():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 6)) + rng.normal(size=(8, 6))[rng.integers(0, 8, 1500)] * 3
    graph, first = nearest.near_graph(x, 8), nearest.median_splits(x, 10)
    part = nearest.balanced_parts(graph, first, 10)
    assert np.ptp(np.bincount(first, minlength=10)) <= 1 and (np.bincount(part) == np.bincount(first)).all()
    assert (part[graph] != part[:, None]).sum() < (first[graph] != first[:, None]).sum()


def test_learning_holds_no_large_matrix():
    import tracemalloc

    x = np.random.default_rng(2).normal(size=(4000, 8))
    router = nearest.Router(x.mean(axis=0), 1.0, np.ones((9, 128)), np.ones((129, 128)))
    tracemalloc.start()
    graph = nearest.near_graph(x, 5)
    p = router.probabilities(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The graph by blocks of 8 MB instead of 33 MB at a time, each held some three times.
    assert peak < 40e6 and p.shape == (4000, 128) and np.allclose(p, 1 / 128)
    far = ((x[:50, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    far[np.arange(50), np.arange(50)] = np.inf
    assert [set(g) for g in graph[:50].tolist()] == [set(o) for o in np.argsort(far, axis=1)[:, :5].tolist()]


def test_sample_is_of_the_smallest_hashes_and_few_rows_are_sent(spark):
    from pyspark.sql import functions as F

    points = spark.range(20_000).select(F.array("id").alias("ids"), F.array(F.col("id").cast("float"), F.lit(1).cast("float")).alias("vec")).repartition(20)
    want = [[float(r.id), 1.0] for r in spark.range(20_000).orderBy(F.xxhash64("id"), "id").limit(300).collect()]
    assert nearest.drawn(points, 20_000, 300).tolist() == want
    assert nearest.drawn(points.limit(0), 0, 300).shape == (0, 0) and len(nearest.drawn(points, 20_000, 30_000)) == 20_000


def test_copies_ties_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(900)]  # many ties
    rows += [(i, [1.0, 1.0, 1.0, 1.0]) for i in range(900, 1500)]  # one very common vector
    rows += [(2000, None), (2100, [0.0] * 4), (2200, [1.0, None, 0.0, 0.0]), (2300, [1.0, float("nan"), 0.0, 0.0]), (2400, [float("inf"), 0.0, 0.0, 0.0]),
             (None, [1.0] * 4), (2500, [1.0, 2.0]), (2600, []), (2700, [2.0, 2.0, 2.0, 2.0]), (2700, [2.0, 2.0, 2.0, 2.0]), (2800, [0.5] * 4), (2800, [0.25] * 4)]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, part string")
    want = brute([r for r in rows if r[1] is None or len(r[1]) == 4], 10, 100)
    assert lists(nearest.nearest(frame, part_rows=10**6, block_rows=64, chunk_queries=3)) == want
    assert 2800 in want and 2000 not in want


def test_few_rows_and_empty(spark):
    frame = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.0, 1.0]), (7, [1.0, 1.0])], "vec_id bigint, embedding array<double>")
    assert lists(nearest.nearest(frame)) == {0: [(7, 1.0), (100, 2**0.5)], 100: [(7, 1.0), (0, 2**0.5)]}
    assert nearest.nearest(frame.limit(0)).count() == 0 and nearest.nearest(frame.where("vec_id = 0")).count() == 0
