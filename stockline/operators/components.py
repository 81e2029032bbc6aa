"""Connected components of an undirected graph by alternating star steps.

A node with more than a ten-thousandth of all edges is heavy: there are fewer
than ten thousand of them, so their list is broadcast, and the edges of each
are dealt to as many parts as it takes to make them ordinary. No task reads
more of one node's edges than that, whatever the shape of the graph. Rounds
are written to the shared folder, and a round's copy is deleted when the next
one stands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockline.session import on_new_path
from stockline.sources.files import remove_path

#: No node has more than this many heavy companions; the list of all of them is broadcast.
MOST_HEAVY = 10_000
#: A node of fewer edges is never heavy.
ORDINARY = 64


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def dealt_edges(directed: DataFrame, rows: int, least: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``directed`` with the part of its node that an edge belongs to, and each part with its node's ``least``.

    ``rows`` is the number of edges, or a bound above it; ``least`` is an aggregate, the smallest neighbour by default.
    """
    ordinary = max(ORDINARY, rows // MOST_HEAVY)
    best = F.min("v") if least is None else least
    return _dealt(directed, directed.groupBy("u").agg(best.alias("least"), F.ceil(F.count(F.lit(1)) / ordinary).alias("parts")))


def _dealt(directed: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``dealt_edges``, from nodes with ``least`` and their number of ``parts``."""
    parts = nodes.select("u", "least", F.explode(F.sequence(F.lit(1).cast("long"), "parts")).alias("part"))
    heavy = nodes.filter("parts > 1").select("u", "parts")
    dealt = directed.join(F.broadcast(heavy), "u", "left").select(
        *directed.columns, F.coalesce(F.pmod(F.xxhash64("v"), "parts") + 1, F.lit(1).cast("long")).alias("part"))
    return dealt, parts


def _with_least(directed: DataFrame, rows: int, used: list[str]) -> DataFrame:
    """Each edge with the smallest node among ``u`` and its neighbours.

    ``directed`` must be cheap to read twice. The nodes' totals are written
    first: only where some node is heavy are edges dealt, so a round without
    one is a plain join, planned and broadcast by the true size of the totals.
    Their path is added to ``used``, for the caller to delete.
    """
    ordinary = max(ORDINARY, rows // MOST_HEAVY)
    totals = directed.groupBy("u").agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("n"))
    nodes, path = on_new_path(totals, "nodes")
    used.append(path)
    if nodes.filter(F.col("n") > ordinary).isEmpty():
        linked = directed.join(nodes, "u")
    else:
        dealt, least = _dealt(directed, nodes.withColumn("parts", F.ceil(F.col("n") / ordinary)))
        linked = dealt.join(least, ["u", "part"])
    return linked.select("u", "v", F.least("u", "least").alias("least"))


def _large_star(edges: DataFrame, rows: int, used: list[str]) -> DataFrame:
    linked = _with_least(_both_ways(edges), 2 * rows, used)
    return linked.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))


def _small_star(edges: DataFrame, rows: int, used: list[str]) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_least(down, rows, used)
    pairs = F.array(F.struct(F.col("v").alias("u"), F.col("least").alias("v")), F.struct("u", F.col("least").alias("v")))
    return linked.select(F.inline(pairs))


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("u") != F.col("v")).distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(nodes: DataFrame, edges: DataFrame, node: str = "node") -> DataFrame:
    """``(node, component)``: each node with the smallest node it is linked to.

    ``edges`` has columns ``u`` and ``v``. Every round turns the graph into
    flatter stars; it ends when a round changes nothing, each node then being
    linked to its smallest one directly.
    """
    spark = nodes.sparkSession
    current, path = on_new_path(_tidy(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), "stars")
    before = None
    while True:
        mark = _fingerprint(current)
        if mark == before or mark[0] == 0:
            break
        before, used = mark, [path]
        # A large star makes no more edges than both directions of what it is given.
        wide, between = on_new_path(_large_star(current, mark[0], used), "stars")
        current, path = on_new_path(_tidy(_small_star(wide, 2 * mark[0], used)), "stars")
        for old in (*used, between):
            remove_path(spark, old)
    roots = current.groupBy(F.col("u").alias(node)).agg(F.min("v").alias("component"))
    return (nodes.select(node).join(roots, node, "left")
            .select(node, F.coalesce("component", node).alias("component")))
