"""A Merkle manifest of a dataset: a tree of digests per group, one tree over the groups, and a proof per row.

Leaves are digests of whole rows. Within a group they ascend by their key, and while several nodes remain every three
consecutive ones (the last run: fewer, even one) become one digest. The groups' last nodes are joined alike.

Built levels are stored as node rows that name their parent. A node row holds the sub-tree of 243 consecutive nodes, five
levels of runs of three: on 30 GB of documents rows of single nodes would carry about 3.4 times the input through
shuffles while climbing, these about once. A recursive query climbs from the leaves: it meets each node row's parent,
appends the siblings of the levels passed and folds every leaf's own, possibly tampered, digest. Leaves of one node row
travel together and share the siblings above it, but each is folded by itself.

Positions of leaves come from slices of a range partitioning plus the totals of earlier slices, so a group with a third
of all rows, or rows repeated very often, are spread over tasks. Nothing is collected but single numbers.

Null keys and groups are defined: a null group is a group of its own and comes first, a null key comes first in its group
and is never tampered, equal keys ascend by their digest; repeated rows are leaves of their own. An empty table gives
no rows. Columns besides those named are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stockline.llm.common import stored

RUN = 3
PAGE = 243  # five levels of runs of three
_STEPS = [1, 3, 9, 27, 81]
TOP = ":"  # the tree over groups; trees of groups are named "" (null) or "=" and the group
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(fields: Sequence[Column]) -> Column:
    """Digest of a row: each field as its UTF-8 byte count, a colon and its value, or a dash for null."""
    strings = [c.cast("string") for c in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
                             for s in strings]), 256)


def numbered(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with the row's position in its group from zero (``idx``) and the group's size (``n``).

    ``group`` holds no nulls. Slices of a range partitioning are numbered apart and moved by the totals of earlier
    slices; equal rows are spread by the order they were written in.
    """
    written = stored(df.withColumn("at", F.monotonically_increasing_id()), name)
    sliced = stored(written.repartitionByRange(group, *order, "at").withColumn("slice", F.spark_partition_id()), f"{name}-slices")
    totals = sliced.groupBy(group, "slice").agg(F.count(F.lit(1)).alias("here"))
    earlier = Window.partitionBy(group).orderBy("slice")
    moved = totals.select(
        group, "slice", (F.sum("here").over(earlier) - F.col("here")).alias("before"),
        F.sum("here").over(Window.partitionBy(group)).alias("n"))
    here = Window.partitionBy(group, "slice").orderBy(*order, "at")
    placed = sliced.withColumn("place", F.row_number().over(here)).join(moved, [group, "slice"])
    return placed.withColumn("idx", F.col("before") + F.col("place") - 1).drop("at", "slice", "place", "before")


_UP = f"""transform(sequence(0, (size(nodes) - 1) div {RUN}), i -> sha2(array_join(slice(nodes, i * {RUN} + 1, {RUN}), ''), 256))"""


def _subtree(nodes: str, height: str) -> Column:
    """All levels over an array of digests, lowest first."""
    return F.expr(f"""aggregate(sequence(1, 5), array({nodes}), (levels, l) ->
        IF(l > {height}, levels, concat(levels, array(transform(array(levels[l - 1]), nodes -> {_UP})[0]))))""")


def build_pages(nodes: DataFrame, name: str) -> DataFrame:
    """Node rows of trees given as ``(tree, idx, n, hash)``: tree, level, page, levels, top, last.

    Each round stores the next row of sub-trees; there are as many rounds as the logarithm of the largest tree's
    size to the base 243.
    """
    rounds, level = [], 0
    while True:
        height = sum((F.col("n") > step).cast("int") for step in _STEPS)
        pages = stored(
            nodes.groupBy("tree", F.expr(f"idx div {PAGE}").alias("page")).agg(
                F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("idx", "hash")))["hash"].alias("leaves"))
            .select("tree", F.lit(level).alias("level"), "page", "n", "leaves", height.alias("height"))
            .select("tree", "level", "page", "n", _subtree("leaves", "height").alias("levels"))
            .withColumn("top", F.expr("element_at(levels, -1)[0]"))
            .withColumn("last", F.col("n") <= PAGE), f"{name}-{level}")
        rounds.append(pages)
        rest = pages.filter(~F.col("last"))
        if rest.isEmpty():
            break
        nodes = rest.select("tree", F.col("page").alias("idx"), F.expr(f"(n + {PAGE - 1}) div {PAGE}").alias("n"), F.col("top").alias("hash"))
        level += 1
    found = rounds[0]
    for pages in rounds[1:]:
        found = found.unionAll(pages)
    return found


def manifest(leaves: DataFrame, name: str = "manifest") -> tuple[DataFrame, DataFrame]:
    """``(leaves with their places, node rows that name their parents)`` of leaves ``(tree, key, hash, …)``."""
    placed = stored(numbered(leaves, "tree", ["key", "hash"], f"{name}-leaves"), f"{name}-placed")
    below = build_pages(placed, f"{name}-pages")
    tops = below.filter("last").select("tree", F.col("top").alias("hash")).withColumn("over", F.lit(TOP))
    groups = stored(numbered(tops, "over", ["tree"], f"{name}-groups"), f"{name}-tops")
    above = build_pages(groups.select(F.col("over").alias("tree"), "idx", "n", "hash"), f"{name}-top-pages")

    def linked(pages: DataFrame, tree: Column, level: Column, position: Column) -> DataFrame:
        return pages.select(
            "tree", "level", "page", "levels", "top", tree.alias("parent_tree"), level.cast("int").alias("parent_level"),
            F.floor(position / PAGE).cast("long").alias("parent_page"), (position % PAGE).cast("int").alias("parent_at"))

    inner = below.unionAll(above)
    up = linked(inner.filter(~F.col("last")), F.col("tree"), F.col("level") + 1, F.col("page"))
    over = linked(below.filter("last").join(groups.select("tree", "over", F.col("idx").alias("rank")), "tree"),
                  F.col("over"), F.lit(0), F.col("rank"))
    none = linked(above.filter("last"), F.lit(None).cast("string"), F.lit(None), F.lit(None).cast("long"))
    return placed, stored(up.unionAll(over).unionAll(none), f"{name}-nodes")


# Siblings of position ``i`` in a level's array: the others of its run, left and right of it.
_LEFT = f"array_join(slice(level, a.i - a.i % {RUN} + 1, a.i % {RUN}), '')"
_RIGHT = f"array_join(slice(level, a.i + 2, {RUN - 1} - a.i % {RUN}), '')"
_PASSED = "slice(p.levels, 1, size(p.levels) - 1)"
_FOLD = f"""transform(c.folded, (f, k) -> aggregate({_PASSED}, named_struct('i', c.at[least(k, size(c.at) - 1)], 'h', f),
    (a, level) -> named_struct('i', CAST(a.i div {RUN} AS INT), 'h', sha2(concat({_LEFT}, a.h, {_RIGHT}), 256))).h)"""
_SIBLINGS = f"""transform(c.at, x -> aggregate({_PASSED}, named_struct('i', x, 's', ''),
    (a, level) -> named_struct('i', CAST(a.i div {RUN} AS INT), 's', concat(a.s, {_LEFT}, {_RIGHT}))).s)"""

CLIMB = f"""
WITH RECURSIVE climb (block_tree, block_page, step, tree, level, page, at, folded, siblings, subroot, root) AS (
  SELECT tree, page, 0, tree, 0, page, at, folded, CAST(NULL AS ARRAY<STRING>), CAST(NULL AS STRING), CAST(NULL AS STRING)
  FROM {{starts}}
  UNION ALL
  SELECT c.block_tree, c.block_page, c.step + 1, p.parent_tree, p.parent_level, p.parent_page, array(p.parent_at), {_FOLD}, {_SIBLINGS},
    CASE WHEN p.parent_tree = '{TOP}' AND p.tree <> '{TOP}' THEN p.top END, CASE WHEN p.parent_tree IS NULL THEN p.top END
  FROM climb c JOIN {{nodes}} p ON c.tree = p.tree AND c.level = p.level AND c.page = p.page)
SELECT block_tree, block_page, step, siblings, subroot, root, CASE WHEN tree IS NULL THEN folded END AS folded FROM climb WHERE step > 0"""


def climb(spark: SparkSession, starts: DataFrame, nodes: DataFrame) -> DataFrame:
    """The recursive query, run to its end and stored; its rows are bounded by the height, not by a number of rows."""
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        return stored(spark.sql(CLIMB, starts=starts, nodes=nodes), "climb")
    finally:
        spark.conf.unset(limit) if before is None else spark.conf.set(limit, before)


def audit_rows(docs: DataFrame, tampered: Column, fields: Sequence[str] = FIELDS, group: str = "source", key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """Per row: key, leaf, subroot, root, digest of its proof, root folded from the tampered row, whether they agree.

    Where ``tampered`` holds, all line feeds of ``text`` are gone when the row is checked.
    """
    plain = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*fields, group, key, text])])
    changed = F.when(F.coalesce(tampered, F.lit(False)), F.regexp_replace(text, "\n", "")).otherwise(F.col(text))
    leaves = plain.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("tree"), F.col(key).alias("key"),
        digest([F.col(c) for c in fields]).alias("hash"),
        digest([changed if c == text else F.col(c) for c in fields]).alias("found"))
    placed, nodes = manifest(leaves)
    blocks = stored(placed.groupBy("tree", F.expr(f"idx div {PAGE}").alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("idx", "key", "hash", "found"))).alias("rows")), "blocks")
    starts = blocks.select("tree", "page", F.expr("sequence(0, size(rows) - 1)").alias("at"), F.col("rows.found").alias("folded"))
    passed = climb(docs.sparkSession, starts, nodes).groupBy(F.col("block_tree").alias("tree"), F.col("block_page").alias("page")).agg(
        F.sort_array(F.collect_list(F.struct("step", "siblings")))["siblings"].alias("siblings"),
        F.max("subroot").alias("subroot"), F.max("root").alias("root"), F.first("folded", ignorenulls=True).alias("folded"))
    each = blocks.join(passed, ["tree", "page"]).select(
        "subroot", "root", "siblings", F.posexplode(F.arrays_zip("rows", "folded")).alias("at", "row"))
    proof = F.expr("concat(siblings[0][at], array_join(transform(slice(siblings, 2, size(siblings)), s -> s[0]), ''))")
    return each.select(
        F.col("row.rows.key").alias(key), F.col("row.rows.hash").alias("leaf"), "subroot", "root",
        F.sha2(proof, 256).alias("proof_sha256"), F.col("row.folded").alias("folded_root"),
        (F.col("row.folded") == F.col("root")).alias("verified"))
