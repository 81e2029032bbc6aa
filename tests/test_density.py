"""Clustering against a brute-force implementation, and its work under skew."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockline.functions.distance import EUCLIDEAN, MANHATTAN, METRICS, SQUARED, distance
from stockline.operators import components, density

SCHEMA = "id int, value array<float>"


def frame(spark, points):
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, SCHEMA)


def brute_force(points, eps, min_pts, metric=EUCLIDEAN):
    """Core ids and cluster of every clustered point, from the full distance matrix."""
    x = np.asarray(points, dtype=np.float32).astype(float)
    gaps = x[:, None, :] - x[None, :, :]
    d = np.abs(gaps).sum(2) if metric == MANHATTAN else np.sqrt((gaps ** 2).sum(2))
    near = d <= eps
    core = near.sum(1) >= min_pts
    label = np.full(len(x), -1)
    for i in np.flatnonzero(core):
        if label[i] >= 0:
            continue
        todo, label[i] = [i], i
        while todo:
            for k in np.flatnonzero(near[todo.pop()] & core):
                if label[k] < 0:
                    label[k] = i
                    todo.append(k)
    for i in np.flatnonzero(~core):
        owners = label[near[i] & core]
        if len(owners):
            label[i] = owners.min()
    return set(np.flatnonzero(core)), {int(i): int(c) for i, c in enumerate(label) if c >= 0}


def check(spark, points, eps, min_pts, metric=EUCLIDEAN):
    hood = density.neighbourhood(frame(spark, points), eps, min_pts, metric)
    core, want = brute_force(points, eps, min_pts, metric)
    assert {r.id for r in density.core_points(hood).collect()} == core
    found = density.clusters(hood)
    rows = found.collect()
    got = {r.point: r.component for r in rows}
    assert len(got) == len(rows)
    assert got == want
    assert {r.id for r in density.noise(hood, found).collect()} == set(range(len(points))) - set(want)
    return hood


def blobs():
    rng = np.random.default_rng(5)
    return np.concatenate([rng.normal(c, 0.4, (250, 2)) for c in ((1, 1), (-1, -1), (1, -1))])


def rings():
    rng = np.random.default_rng(11)
    theta = np.linspace(0, 2 * np.pi, 500)
    return np.concatenate([
        rng.random((500, 2)) + np.stack([r * np.cos(theta), r * np.sin(theta)], 1) for r in (0.5, 5)])


@pytest.mark.parametrize("eps", [0.2, 0.3])
def test_blobs(spark, eps):
    points = blobs()
    hood = check(spark, points, eps, 10)
    pairs = density.candidates(hood.points, eps, hood.axes).count()
    assert pairs < {0.2: 149716, 0.3: 217624}[eps]


def test_rings(spark):
    check(spark, rings(), 0.3, 5)


@pytest.mark.parametrize("metric", [MANHATTAN, SQUARED])
def test_metrics_cluster(spark, metric):
    check(spark, blobs()[::3], 0.35, 6, metric)


def test_one_and_five_dimensions(spark):
    rng = np.random.default_rng(3)
    for dim in (1, 5):
        centres = rng.normal(0, 2, (4, dim))
        points = np.concatenate([rng.normal(c, 0.3, (40, dim)) for c in centres])
        check(spark, points, 0.25 * dim, 4)


def test_chain_grows_transitively(spark):
    hood = check(spark, [(0, 0), (0.9, 0), (1.8, 0), (2.7, 0)], 1, 2)
    assert {r.component for r in density.clusters(hood).collect()} == {0}


def test_border_point_takes_the_smallest_cluster(spark):
    left = [(-1 - 0.1 * i, 0) for i in range(4)]
    right = [(1 + 0.1 * i, 0) for i in range(4)]
    points = right + left + [(0.0, 0.0)]
    check(spark, points[::-1], 1.0, 4)


def test_dense_cells_at_the_edge_of_reach(spark):
    """Two dense cells whose nearest points are just within or just out of reach."""
    rng = np.random.default_rng(8)
    a = rng.random((60, 2)) * [0.3, 0.6]
    for gap in (0.98, 1.02):
        b = rng.random((60, 2)) * [0.3, 0.6] + [0.3 + gap, 0]
        edge = np.array([[0.3, 0.3], [0.3 + gap, 0.3]])
        check(spark, np.concatenate([a, b, edge]), 1.0, 5)


def test_hot_cell_needs_no_pairs(spark):
    """Half of all points in one spot: work grows with the points, not their square."""
    rng = np.random.default_rng(2)
    spot = rng.normal(0, 0.01, (3000, 2))
    spread = rng.random((3000, 2)) * 100
    hood = density.neighbourhood(frame(spark, np.concatenate([spot, spread])), 0.5, 5)
    pairs = density.candidates(hood.points, 0.5, hood.axes).count()
    assert pairs < 50_000
    sizes = density.clusters(hood).groupBy("component").count()
    assert sizes.agg(F.max("count")).first()[0] >= 3000


def test_process_interface(spark, tmp_path):
    out = density.process(spark, frame(spark, blobs()), 0.2, 10, EUCLIDEAN, 2, str(tmp_path))
    assert out.columns == ["point", "component"]
    _, want = brute_force(blobs(), 0.2, 10)
    assert {r.point: r.component for r in out.distinct().collect()} == want


def test_distances(spark):
    row = spark.createDataFrame([([0.0, 3.0], [4.0, 0.0])], "a array<float>, b array<float>").select(
        *[distance(F.col("a"), F.col("b"), m).alias(m) for m in METRICS]).first()
    assert (row[EUCLIDEAN], row[MANHATTAN], row[SQUARED]) == (5.0, 7.0, 25.0)
    with pytest.raises(ValueError):
        distance(F.col("a"), F.col("b"), "cosine")


def test_components(spark):
    rng = np.random.default_rng(4)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(300, 360)]
    hub = [(400, i) for i in range(401, 480)]
    parent = list(range(480))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in edges + hub:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    nodes = spark.range(480).select(F.col("id").alias("node"))
    links = spark.createDataFrame(edges + hub, "u long, v long")
    got = {r.node: r.component for r in components.connected_components(nodes, links).collect()}
    assert got == {i: root(i) for i in range(480)}
