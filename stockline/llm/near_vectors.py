"""Near-duplicate vectors by a pivot-permutation index.

Reference vectors (pivots) are drawn from the data: the least hashes of the
ids, twice the square root of the number of different vectors, at most ``most_pivots``. A vector is described
by its ``prefix`` nearest pivots in order. Inverted lists hold, for each pivot, the
vectors that have it in their prefix. Two vectors are a candidate pair if they
share at least ``shared`` pivots; they are compared in the list of the smallest
pivot they share, by cosine in double precision, and linked from ``cosine`` on.

Equal vectors form a class that goes on as one and counts as many. A list is cut
into blocks of ``block`` classes, each pair of blocks being a cell of its own, so a list that
holds a third of all vectors is many small tasks; a cell returns counts of links
and a spanning set of them, never pairs. Memory is one cell and the pivots.

Within a cell the shared pivots of all its pairs are counted as one matrix product; only pairs with
enough of them are verified by cosine.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different lengths do not link; an id with
several vectors has one row for each, with that vector's links, and joins their components.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stockline.llm.common import stored
from stockline.llm.near_text import Groups, cells, named_components, shared_ids
from stockline.operators.components import connected_components


def unit_rows(rows: list[bytes]) -> np.ndarray:
    """Vectors of one length, scaled to length one in double precision."""
    x = np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # first, so that no square overflows
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each row, the nearest first; ties by number."""
    return np.argsort(-(x @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int32)


def _described(classes: DataFrame, pivots: dict[int, np.ndarray], prefix: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            rows = [np.array(v, np.float64) for v in lists.to_pylist()]
            order = [None] * len(rows)
            for size in {len(v) for v in rows}:
                at = [i for i, v in enumerate(rows) if len(v) == size]
                for start in range(0, len(at), 512):
                    part = at[start:start + 512]
                    for i, row in zip(part, nearest_pivots(unit_rows([rows[i].tobytes() for i in part]), pivots[size], prefix), strict=True):
                        order[i] = row
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([v.tobytes() for v in rows], pa.binary()), pa.array([len(v) for v in rows], pa.int32()),
                 pa.array([o.tolist() for o in order], pa.list_(pa.int32())), pa.array([o.tobytes() for o in order], pa.binary())],
                names=["rep", "copies", "vector", "size", "pivots", "prefix"])

    return classes.select("rep", "copies", "value").mapInArrow(run, "rep long, copies long, vector binary, size int, pivots array<int>, prefix binary")


def _cell_links(rows: DataFrame, cosine: float, shared: int) -> DataFrame:
    """``(u, v, links)``: counts of links of ``u`` where ``v`` is null, else a link."""

    def run(batches):
        for table in cells(batches):
            reps, copies = np.array(table.column("rep").to_pylist()), table.column("copies").to_numpy()
            side, pivot = table.column("side").to_numpy(), table.column("pivot")[0].as_py()
            x = unit_rows(table.column("vector").to_pylist())
            prefixes = np.frombuffer(b"".join(table.column("prefix").to_pylist()), np.int32).reshape(len(x), -1)
            known, place = np.unique(prefixes, return_inverse=True)
            has = np.zeros((len(x), len(known)), np.float32)
            np.put_along_axis(has, place.reshape(prefixes.shape), 1, axis=1)
            before = has[:, :int(np.searchsorted(known, pivot))]  # a pair meets in the list of its first shared pivot
            a, b = np.nonzero(np.triu((has @ has.T >= shared) & (before @ before.T == 0), 1) & ((side[:, None] != side[None, :]) | (side[:, None] == 2)))
            counts, groups, links = np.zeros(len(x), np.int64), Groups(), []
            for start in range(0, len(a), 4096):
                i, j = a[start:start + 4096], b[start:start + 4096]
                ok = np.einsum("ij,ij->i", x[i], x[j]) >= cosine
                i, j = i[ok], j[ok]
                np.add.at(counts, i, copies[j])
                np.add.at(counts, j, copies[i])
                for p, q in zip(i.tolist(), j.tolist(), strict=True):
                    if groups.find(p) != groups.find(q):
                        groups.join(p, q)
                        links.append((reps[p], reps[q]))
            hit = np.flatnonzero(counts)
            if len(hit):
                yield pa.RecordBatch.from_arrays([
                    pa.array([*reps[hit].tolist(), *(int(p) for p, _ in links)], pa.int64()), pa.array([*[None] * len(hit), *(int(q) for _, q in links)], pa.int64()),
                    pa.array([*counts[hit].tolist(), *[0] * len(links)], pa.int64())], names=["u", "v", "links"])

    return rows.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "u long, v long, links long")


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9, prefix: int = 10,
                 shared: int = 2, most_pivots: int = 4096, block: int = 512) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every row."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("value"))
    good = (F.col("value").isNotNull() & F.forall("value", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
            & F.exists("value", lambda v: v != 0))
    good = F.coalesce(good & F.col("vec_id").isNotNull(), F.lit(False))
    classes = stored(rows.filter(good).groupBy("value").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
                     .withColumn("rep", F.monotonically_increasing_id()), "vectors")

    pivots: dict[int, np.ndarray] = {}
    for size, n in classes.groupBy(F.size("value").alias("s")).count().orderBy("s").collect():
        wanted = int(min(most_pivots, max(16, 2 * n ** 0.5)))
        drawn = classes.filter(F.size("value") == size).orderBy(F.xxhash64("first_id"), "first_id", "value").limit(wanted).select("value").collect()
        pivots[size] = unit_rows([np.array(r[0], np.float64).tobytes() for r in drawn])
    described = stored(_described(classes, pivots, prefix), "described")

    listed = described.select("rep", "size", F.explode("pivots").alias("pivot"))
    lengths = listed.groupBy("size", "pivot").agg(F.ceil(F.count("*") / block).alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    met = described.select("*", F.explode("pivots").alias("pivot")).join(lengths, ["size", "pivot"]).withColumn("own", own)
    to = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.struct(
        F.when(j == F.col("own"), 2).when(j > F.col("own"), 0).otherwise(1).alias("side"),
        F.xxhash64("size", "pivot", F.least(F.col("own"), j), F.greatest(F.col("own"), j)).alias("cell")))
    cell_rows = met.select("rep", "copies", "vector", "prefix", "pivot", F.explode(to).alias("to")).select(
        "rep", "copies", "vector", "prefix", "pivot", "to.side", "to.cell")
    found = stored(_cell_links(cell_rows, cosine, shared), "links")
    counts = found.filter("v is null").groupBy("u").agg(F.sum("links").alias("links"))
    links = stored(found.filter("v is not null").select("u", "v")
                   .unionByName(shared_ids(rows.filter(good).select("vec_id", "value"), classes, "vec_id", "value")), "edges")
    linked = links.select(F.col("u").alias("rep")).unionAll(links.select(F.col("v").alias("rep"))).distinct()
    comps = named_components(classes, connected_components(linked, links, "rep"))
    placed = (classes.join(comps, "rep", "left").join(counts, F.col("rep") == F.col("u"), "left")
              .select("value", F.coalesce("component_id", "first_id").alias("component"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    keyed = rows.withColumn("good", good).withColumn("value", F.when(F.col("good"), F.col("value")))
    return (keyed.join(placed, "value", "left").select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                                                       F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
