"""The manifest against a plain computation in Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from stockline.llm.manifest import audit_rows, build_pages
from stockline.llm.queries import op13_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values) -> str:
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def levels(nodes: list[str]) -> list[list[str]]:
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([digest(*found[-1][i:i + 3]) for i in range(0, len(found[-1]), 3)])
    return found


def climb(tree: list[list[str]], at: int, node: str) -> tuple[str, str]:
    passed = ""
    for level in tree[:-1]:
        run = level[at // 3 * 3:at // 3 * 3 + 3]
        left, right = "".join(run[:at % 3]), "".join(run[at % 3 + 1:])
        passed, node, at = passed + left + right, digest(left, node, right), at // 3
    return passed, node


def expected(rows: list[tuple]) -> list[tuple]:
    groups: dict = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([h for _, _, h, _ in sorted(groups[s], key=lambda g: g[:3])]) for s in order}
    top = levels([trees[s][-1][0] for s in order])
    out = []
    for place, source in enumerate(order):
        for at, (_, _, h, row) in enumerate(sorted(groups[source], key=lambda g: g[:3])):
            text = row[4]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            below, node = climb(trees[source], at, leaf((*row[:4], text)))
            above, node = climb(top, place, node)
            out.append((row[0], h, trees[source][-1][0], top[-1][0], digest(below + above), node, node == top[-1][0]))
    return sorted(out, key=str)


def audited(spark, rows, schema=SCHEMA):
    found = audit_rows(spark.createDataFrame(rows, schema), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)
    return sorted(map(tuple, found.collect()), key=str)


def test_of_groups_of_many_sizes_nulls_ties_and_repeated_rows(spark):
    rows = [(i, f"s{size}", "en", i, f"text {i}\nend") for size in (1, 2, 3, 4, 243, 244, 730, 800) for i in range(size)]
    rows += [(1, None, None, None, None), (None, None, "x", 3, "a\nb"), (None, "é", "x", 3, "a\nb"), (5, "", "de", 0, ""), (5, "", "de", 0, ""),
             (5, "", "de", 0, "other\n"), (7, "Z", "fr", 1, "é\n" * 20000)]
    assert audited(spark, rows) == expected(rows)


def test_many_groups_make_a_tree_of_several_node_rows(spark):
    rows = [(i, f"group {i}", "en", 1, "a\nb") for i in range(600)]
    assert audited(spark, rows) == expected(rows)


@pytest.mark.parametrize("rows", [[], [(1, "s", "en", 1, "a\n")], [(0, "s", "en", 1, "a\n")] * 30])
def test_small_tables(spark, rows):
    assert audited(spark, rows) == expected(rows)


def test_columns_with_names_used_inside(spark):
    rows = [(i, "s", "en", i, f"{i}\n", "x", "y", 0) for i in range(10)]
    found = audited(spark, rows, SCHEMA + ", tree string, hash string, idx int")
    assert found == expected([r[:5] for r in rows])


def test_levels_of_a_node_row_stop_at_one_node_in_the_last_row_only(spark):
    nodes = spark.range(244).selectExpr("'t' tree", "id idx", "244L n", "sha2(string(id), 256) hash")
    sizes = [[len(level) for level in r.levels] for r in build_pages(nodes, "probe").orderBy("level", "page").collect()]
    assert sizes == [[243, 81, 27, 9, 3, 1], [1, 1, 1, 1, 1, 1], [2, 1]]


def test_query_over_given_tables(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert sorted(map(tuple, op13_manifest(spark, small).collect()), key=str) == expected(rows)
