"""The pivot tree behind the exact neighbours: bounded leaves at every level, few visits, nothing lost."""

import numpy as np
import pytest

from creditloom.operators import neighbours as N


def brute(points, k):
    x = np.array([v for _, v in points])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    return np.sort(d, axis=1)[:, :k]


def clouds(n, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.uniform(-50, 50, (6, 2))
    x = np.concatenate([centres[rng.integers(0, 6, n - 40)] + rng.normal(0, 1, (n - 40, 2)), rng.uniform(-500, 500, (40, 2))])
    return [(i, [float(a) for a in v]) for i, v in enumerate(x)]


@pytest.fixture()
def narrow(monkeypatch):
    """Few children and small tasks, so that small inputs need several levels and salts."""
    monkeypatch.setattr(N, "FAN", 12)
    monkeypatch.setattr(N, "TASK_ROWS", 300)


def test_levels_leaves_and_visits(spark, narrow):
    points = spark.createDataFrame(clouds(3000), "id bigint, vec array<double>")
    leaves, levels = N.pivot_tree(points, 40, 42)
    sizes = [r["n"] for r in leaves.groupBy("cell").count().withColumnRenamed("count", "n").collect()]
    assert len(levels) >= 2 and max(sizes) <= 40 and sum(sizes) == 3000
    visits = N.visited_leaves(leaves, levels, 4, 40)
    per_point = visits.groupBy("id").count()
    # Some leaves around each point (19.7 here, where leaves hold about ten points), however many there are in all.
    assert per_point.count() == 3000 and visits.count() <= 20 * 3000 < 3000 * len(sizes)
    assert visits.select("id", "cell").exceptAll(visits.select("id", "cell").distinct()).isEmpty()


def test_equal_to_brute_force(spark, narrow):
    points = clouds(900)
    found = N.nearest_neighbours(spark.createDataFrame(points, "id bigint, vec array<double>"), 4, "id", block_rows=25).collect()
    got = np.full((900, 4), np.nan)
    for r in found:
        got[r["id"], r["place"] - 1] = r["distance"]
    assert np.allclose(got, brute(points, 4), atol=1e-9)


def test_points_too_close_to_tell_apart(spark, narrow):
    """Squares of the differences vanish, so every distance is 0; the cells are split all the same."""
    points = spark.createDataFrame([(i, [i * 1e-300]) for i in range(200)], "id bigint, vec array<double>")
    rows = N.nearest_neighbours(points, 2, "id", block_rows=20).collect()
    assert len(rows) == 400 and {r["distance"] for r in rows} == {0.0}
    assert {(r["id"], r["neighbour"]) for r in rows} == {(i, j) for i in range(200) for j in ([1, 2] if i == 0 else [0, 2] if i == 1 else [0, 1])}


def test_empty(spark):
    assert N.nearest_neighbours(spark.createDataFrame([], "id bigint, vec array<double>"), 3, "id").count() == 0
