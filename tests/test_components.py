"""Components of graphs with hubs, chains and loops against a plain search."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from stockline.operators import components
from stockline.session import shared_folder
from stockline.sources.files import child_names


def plain(nodes, edges):
    near = {n: set() for n in nodes}
    for u, v in edges:
        near[u].add(v)
        near[v].add(u)
    out = {}
    for start in sorted(nodes):
        if start not in out:
            todo, out[start] = [start], start
            while todo:
                for n in near[todo.pop()]:
                    if n not in out:
                        out[n] = start
                        todo.append(n)
    return out


def found(spark, nodes, edges):
    rows = components.connected_components(
        spark.createDataFrame([(n,) for n in nodes], "node long"), spark.createDataFrame(edges, "u long, v long"))
    return {r.node: r.component for r in rows.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs_with_loops_and_repeated_edges(spark, seed):
    draw = random.Random(seed)
    nodes = list(range(300))
    edges = [(draw.randrange(300), draw.randrange(300)) for _ in range(130 + 60 * seed)] + [(5, 5), (1, 2), (2, 1)]
    assert found(spark, nodes, edges) == plain(nodes, edges)


def test_chain_hubs_and_a_node_without_edges(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1400)] + [(i, 5000) for i in range(2000, 2300)] + [(1399, 2299)]
    nodes = sorted({n for e in edges for n in e} | {9999})
    assert found(spark, nodes, edges) == plain(nodes, edges)


def test_no_edges(spark):
    assert found(spark, [1, 2], []) == {1: 1, 2: 2}


@pytest.mark.parametrize("hub", [0, 1_000_000])
def test_a_star_of_a_million_leaves_is_dealt_to_many_parts(spark, hub):
    leaves = spark.range(1, 1_000_000)
    edges = leaves.select(F.lit(hub).cast("long").alias("u"), F.col("id").alias("v"))
    dealt, least = components.dealt_edges(edges, 999_999)
    sizes = dealt.groupBy("u", "part").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] < 1000 and sizes[1] == least.count() >= 999_999 // sizes[0]
    nodes = leaves.select(F.col("id").alias("node")).unionAll(spark.createDataFrame([(hub,)], "node long"))
    root = min(hub, 1)
    assert components.connected_components(nodes, edges).filter(F.col("component") != root).count() == 0


def test_only_the_last_round_is_kept(spark):
    before = {n for n in child_names(spark, shared_folder(spark)) if n.startswith("stars")}
    found(spark, range(50), [(i, i + 1) for i in range(49)])
    after = {n for n in child_names(spark, shared_folder(spark)) if n.startswith("stars")}
    assert len(after - before) == 1
