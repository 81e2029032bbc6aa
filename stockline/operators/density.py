"""Density-based clustering (DBSCAN) without comparing all pairs.

Space is cut into cells so small that any two points of a cell are
neighbours. A cell with ``min_pts`` points is *dense*: all its points are core
points of one cluster, however many they are, and none of them is compared
with another. Distances are computed

* from points of the other cells, of which a cell holds fewer than
  ``min_pts``, to the points around them, and
* between dense cells, on bounding boxes that are halved only where the
  answer is still open.

Dense cells and the remaining core points are the nodes of a graph whose
connected components are the clusters.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockline.functions.distance import EUCLIDEAN, MANHATTAN, exact_distance, radius
from stockline.operators.components import connected_components
from stockline.session import durable

# Searching uses at most this many coordinates, those that spread most;
# distances use all of them.
SEARCH_DIMS = 3
# Boxes are cut to a quarter per step; what is open after the last step is
# settled on the points themselves.
SPLIT_BITS = 2
SPLIT_STEPS = 12


@dataclass(frozen=True)
class Neighbourhood:
    """What the clustering asks of the points, each computed once.

    ``points``: id, value, cell, node, dense. ``node`` is the smallest id of a
    dense cell, or the point itself. ``near``: for each point outside dense
    cells, how many points it reaches, by node.
    """

    points: DataFrame
    near: DataFrame
    min_pts: int
    eps: float
    metric: str
    dim: int
    axes: tuple[int, ...]

    def core_ids(self) -> DataFrame:
        """Core points outside dense cells."""
        return (self.near.groupBy("id").agg(F.sum("hits").alias("n"))
                .filter(F.col("n") >= self.min_pts).select("id"))


def cell_side(eps: float, dim: int, metric: str) -> float:
    """Side of a cell whose diameter stays below ``eps``."""
    return eps / (dim if metric == MANHATTAN else math.sqrt(dim)) * (1 - 1e-9)


def _grid(value: Column, side: float, axes: Sequence[int] | None = None) -> Column:
    part = value if axes is None else F.array(*[value[i] for i in axes])
    return F.transform(part, lambda x: F.floor(x / F.lit(side)))


def _around(bucket: Column, dims: int) -> Column:
    """The bucket and those touching it, one per row."""
    steps = F.array(*[F.array(*[F.lit(s).cast("long") for s in step])
                      for step in itertools.product((-1, 0, 1), repeat=dims)])
    return F.explode(F.transform(steps, lambda step: F.zip_with(bucket, step, lambda a, b: a + b)))


def search_axes(located: DataFrame, dim: int) -> tuple[int, ...]:
    """The coordinates to search on: all, or the most spread ones if there are many."""
    if dim <= SEARCH_DIMS:
        return tuple(range(dim))
    spread = located.agg(*[F.var_pop(F.col("value")[i]) for i in range(dim)]).first()
    widest = sorted(range(dim), key=lambda i: (-(spread[i] or 0.0), i))
    return tuple(sorted(widest[:SEARCH_DIMS]))


def locate(points: DataFrame, eps: float, min_pts: int, metric: str = EUCLIDEAN, dim: int | None = None,
           id_col: str = "id", value_col: str = "value") -> DataFrame:
    """Points with their cell, and whether the cell is dense."""
    size = dim or points.select(F.size(value_col)).first()[0]
    placed = points.select(F.col(id_col).alias("id"), F.col(value_col).cast("array<double>").alias("value"))
    placed = durable(placed.withColumn("cell", _grid(F.col("value"), cell_side(eps, size, metric))))
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    dense = cells.filter(F.col("n") >= min_pts).select("cell", "first")
    return (placed.join(dense, "cell", "left")
            .select("id", "value", "cell", F.coalesce("first", "id").alias("node"),
                    F.col("first").isNotNull().alias("dense")))


def candidates(located: DataFrame, eps: float, axes: Sequence[int]) -> DataFrame:
    """Points outside dense cells paired with all points of the buckets around."""
    bucket = _grid(F.col("value"), eps, axes)
    loose = located.filter(~F.col("dense")).select(
        F.col("id"), F.col("value").alias("here"), _around(bucket, len(axes)).alias("bucket"))
    others = located.select(F.col("id").alias("other"), "node", "dense", F.col("value").alias("there"),
                            bucket.alias("bucket"))
    return loose.join(others, "bucket")


def eps_neighbours(located: DataFrame, eps: float, axes: Sequence[int], metric: str = EUCLIDEAN) -> DataFrame:
    """``(id, other)`` within ``eps``, itself included, for points outside dense cells.

    Points of a dense cell are all within ``eps`` of each other by
    construction; listing their pairs would grow with the square of the cell.
    """
    close = exact_distance(F.col("here"), F.col("there"), metric) <= radius(eps, metric)
    return candidates(located, eps, axes).filter(close).select("id", "other", "node", "dense")


def loose_neighbours(points: DataFrame, eps: float, min_pts: int, metric: str = EUCLIDEAN,
                     dim: int | None = None, id_col: str = "id", value_col: str = "value") -> DataFrame:
    """``(id, other)`` within ``eps``, itself included, for every point that is not a core point.

    Such a point has fewer than ``min_pts`` neighbours, so the result grows
    with the points. The pairs of core points are not listed: their number
    grows with the square of the density.
    """
    size = dim or points.select(F.size(value_col)).first()[0]
    located = durable(locate(points, eps, min_pts, metric, size, id_col, value_col))
    pairs = durable(eps_neighbours(located, eps, search_axes(located, size), metric).select("id", "other"))
    few = pairs.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < min_pts).select("id")
    return pairs.join(few, "id", "left_semi")


def neighbourhood(points: DataFrame, eps: float, min_pts: int, metric: str = EUCLIDEAN,
                  dim: int | None = None, id_col: str = "id", value_col: str = "value") -> Neighbourhood:
    size = dim or points.select(F.size(value_col)).first()[0]
    located = durable(locate(points, eps, min_pts, metric, size, id_col, value_col))
    axes = search_axes(located, size)
    near = (eps_neighbours(located, eps, axes, metric)
            .groupBy("id", "node", "dense").agg(F.count(F.lit(1)).alias("hits")))
    return Neighbourhood(located, durable(near), min_pts, eps, metric, size, axes)


def core_points(hood: Neighbourhood) -> DataFrame:
    return hood.points.filter("dense").select("id").unionAll(hood.core_ids())


def _box(dim: int) -> list[Column]:
    def corner(fn) -> Column:
        return F.array(*[fn(F.col("value")[i]) for i in range(dim)])

    return [corner(F.min).alias("lo"), corner(F.max).alias("hi")]


def _box_distances(metric: str) -> tuple[Column, Column]:
    """Smallest and largest distance between points of boxes ``a`` and ``b``."""
    gap = F.transform(
        F.arrays_zip(F.col("a_lo").alias("al"), F.col("a_hi").alias("ah"),
                     F.col("b_lo").alias("bl"), F.col("b_hi").alias("bh")),
        lambda z: F.greatest(z["bl"] - z["ah"], z["al"] - z["bh"], F.lit(0.0)))
    reach = F.transform(
        F.arrays_zip(F.col("a_lo").alias("al"), F.col("a_hi").alias("ah"),
                     F.col("b_lo").alias("bl"), F.col("b_hi").alias("bh")),
        lambda z: F.greatest(z["bh"] - z["al"], z["ah"] - z["bl"]))
    origin = F.transform(gap, lambda _: F.lit(0.0))
    return exact_distance(gap, origin, metric), exact_distance(reach, origin, metric)


def _judge(pairs: DataFrame, hood: Neighbourhood) -> DataFrame:
    """Keep box pairs that may be within reach; ``linked`` marks those that are."""
    least, most = _box_distances(hood.metric)
    limit = radius(hood.eps, hood.metric)
    return (pairs.withColumns({"__least": least, "__most": most})
            .filter(F.col("__least") <= limit)
            .withColumn("linked", F.col("__most") <= limit)
            .drop("__least", "__most"))


def _renamed(boxes: DataFrame, side: str, *columns: str) -> DataFrame:
    return boxes.select(*[F.col(c).alias(f"{side}_{c}") for c in columns])


def dense_links(hood: Neighbourhood) -> DataFrame:
    """``(u, v)``: dense cells with a point of one within ``eps`` of one of the other."""
    reach = 2 * hood.eps
    inside = hood.points.filter("dense")
    boxes = durable(inside.groupBy("node").agg(*_box(hood.dim)))
    bucket = _grid(F.col("lo"), reach, hood.axes)
    left = boxes.withColumn("bucket", _around(bucket, len(hood.axes)))
    right = boxes.withColumn("bucket", bucket)
    pairs = (_renamed(left, "a", "node", "lo", "hi", "bucket")
             .join(_renamed(right, "b", "node", "lo", "hi", "bucket"),
                   (F.col("a_bucket") == F.col("b_bucket")) & (F.col("a_node") < F.col("b_node"))))
    judged = durable(_judge(pairs, hood).select("a_node", "b_node", "linked"))

    def as_edges(frame: DataFrame) -> DataFrame:
        return (frame.filter("linked").select(F.col("a_node").alias("u"), F.col("b_node").alias("v")).distinct())

    links = as_edges(judged)
    root = F.array().cast("array<bigint>")
    open_pairs = judged.filter(~F.col("linked")).select("a_node", "b_node",
                                                        root.alias("a_box"), root.alias("b_box"))
    side = cell_side(hood.eps, hood.dim, hood.metric)
    for step in range(1, SPLIT_STEPS + 1):
        if open_pairs.isEmpty():
            return links
        judged = durable(_split(hood, inside, open_pairs, side / (1 << SPLIT_BITS * step), step))
        found = as_edges(judged)
        links = links.unionAll(found)
        open_pairs = (judged.filter(~F.col("linked"))
                      .join(found.select(F.col("u").alias("a_node"), F.col("v").alias("b_node")),
                            ["a_node", "b_node"], "left_anti")
                      .select("a_node", "b_node", "a_box", "b_box"))
    return links.unionAll(_settle(hood, inside, open_pairs, side / (1 << SPLIT_BITS * SPLIT_STEPS)))


def _members(inside: DataFrame, open_pairs: DataFrame) -> DataFrame:
    """Points of the cells that still have an open pair."""
    nodes = (open_pairs.select(F.col("a_node").alias("node"))
             .unionAll(open_pairs.select(F.col("b_node").alias("node"))).distinct())
    return inside.join(nodes, "node", "left_semi")


def _split(hood: Neighbourhood, inside: DataFrame, open_pairs: DataFrame, side: float, step: int) -> DataFrame:
    """Replace both boxes of each open pair by their occupied parts."""
    box = _grid(F.col("value"), side)
    parent = F.transform(F.col("box"), lambda x: F.shiftright(x, SPLIT_BITS)) if step > 1 else (
        F.array().cast("array<bigint>"))
    parts = durable(_members(inside, open_pairs).withColumn("box", box)
                    .groupBy("node", "box").agg(*_box(hood.dim)).withColumn("parent", parent))
    a = _renamed(parts, "a", "node", "parent", "box", "lo", "hi").withColumnRenamed("a_box", "a_part")
    b = _renamed(parts, "b", "node", "parent", "box", "lo", "hi").withColumnRenamed("b_box", "b_part")
    pairs = (open_pairs
             .join(a, (open_pairs.a_node == a.a_node) & (open_pairs.a_box == a.a_parent))
             .drop(a.a_node)
             .join(b, (open_pairs.b_node == b.b_node) & (open_pairs.b_box == b.b_parent))
             .drop(b.b_node))
    return _judge(pairs, hood).select(
        "a_node", "b_node", F.col("a_part").alias("a_box"), F.col("b_part").alias("b_box"), "linked")


def _settle(hood: Neighbourhood, inside: DataFrame, open_pairs: DataFrame, side: float) -> DataFrame:
    """Decide the last open pairs on their distinct points.

    Exact for whatever is left when the boxes are no longer halved; nothing is
    dropped at that step.
    """
    spots = (_members(inside, open_pairs).withColumn("box", _grid(F.col("value"), side))
             .select("node", "box", "value").distinct())
    a, b = _renamed(spots, "a", "node", "box", "value"), _renamed(spots, "b", "node", "box", "value")
    close = exact_distance(F.col("a_value"), F.col("b_value"), hood.metric) <= radius(hood.eps, hood.metric)
    return (open_pairs.join(a, ["a_node", "a_box"]).join(b, ["b_node", "b_box"]).filter(close)
            .select(F.col("a_node").alias("u"), F.col("b_node").alias("v")).distinct())


def clusters(hood: Neighbourhood) -> DataFrame:
    """``(point, component)``; points that belong to no cluster are left out.

    A component is named after its smallest core point. A point on the border
    of several joins the one with the smallest name.
    """
    cores = durable(hood.core_ids())
    from_core = hood.near.join(cores, "id")
    to_core = from_core.filter("dense").unionAll(
        from_core.filter("NOT dense").join(cores.select(F.col("id").alias("node")), "node", "left_semi")
        .select(*from_core.columns))
    edges = to_core.select(F.col("id").alias("u"), F.col("node").alias("v")).unionAll(dense_links(hood))
    nodes = (hood.points.filter("dense").select("node").distinct()
             .unionAll(cores.select(F.col("id").alias("node"))))
    named = durable(connected_components(nodes, edges))

    in_dense = hood.points.filter("dense").select("id", "node").join(named, "node").select("id", "component")
    loose_cores = cores.join(named.withColumnRenamed("node", "id"), "id").select("id", "component")
    border = (hood.near.join(cores, "id", "left_anti").join(named, "node")
              .groupBy("id").agg(F.min("component").alias("component")))
    return in_dense.unionAll(loose_cores).unionAll(border).withColumnRenamed("id", "point")


def noise(hood: Neighbourhood, clustered: DataFrame) -> DataFrame:
    return hood.points.select("id").join(clustered.select(F.col("point").alias("id")), "id", "left_anti")


def process(spark: SparkSession, df: DataFrame, eps: float, min_pts: int, dist: str = EUCLIDEAN,
            dim: int | None = None, checkpoint_dir: str | None = None) -> DataFrame:
    """Cluster ``(id, value array)`` rows into ``(point, component)`` rows."""
    if checkpoint_dir and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return clusters(neighbourhood(df, eps, min_pts, dist, dim))
