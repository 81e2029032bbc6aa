"""Repairs of conversations against all paths of small lattices and a plain table of least labels."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from stockline.llm import conversations as c
from stockline.llm.queries import op12_conversations

SCHEMA = "conv_id long, turn long, role string, text string, kept boolean"


def walked(facts, audit: str, start: int):
    """End state and cost of a string of edits, or None where it is not allowed."""
    state, at, cost = start, 0, 0
    for edit in audit:
        if edit == "I":
            state, cost = c.THEN[state], cost + 3
            continue
        if at == len(facts):
            return None
        initial, gone, extra = facts[at]
        at += 1
        if edit == "D":
            cost += 4
        elif gone:
            return None
        elif edit == "R":
            state, cost = c.THEN[state], cost + 3 + extra
        elif (state, initial) in c.READ:
            state, cost = c.READ[state, initial], cost + extra
        else:
            return None
    return (state, cost) if at == len(facts) else None


def test_least_edits_are_the_least_of_all_paths():
    draw = random.Random(3)
    for _ in range(60):
        facts = [(draw.choice("suax"), draw.random() < 0.2, draw.choice((0, 3))) for _ in range(draw.randint(0, 4))]
        ways = []
        for length in range(len(facts) + 4):
            for edits in itertools.product("DIKR", repeat=length):
                audit = "".join(edits)
                end = walked(facts, audit, c.START)
                if end and end[0] in (c.START, c.ASSISTANT):
                    ways.append((end[1], audit))
        assert c.least_edits(facts, c.START, c.TAIL) == min(ways)


def test_segments_between_all_states():
    draw = random.Random(4)
    for _ in range(30):
        facts = [(draw.choice("sua"), draw.random() < 0.2, draw.choice((0, 3))) for _ in range(draw.randint(1, 3))]
        for s, t in itertools.product(c.STATES, c.STATES):
            ways = [(end[1], "".join(audit)) for n in range(len(facts) + 4) for audit in itertools.product("DIKR", repeat=n)
                    if not audit[-1:] == ("I",) and (end := walked(facts, "".join(audit), s)) and end[0] == t]
            assert c.least_edits(facts, s, {t: (0, "")}) == min(ways, default=None)


def plain(rows: list[tuple]) -> dict[object, dict]:
    """Results by one table of least labels per conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        here = [(t, role if role is not None else " ", text if text is not None else " ") for i, t, role, text, kept in rows if i == conv and kept]
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in here:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            faults.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else "")
            seen.add((role, text))
        label = {c.START: (0, ""), c.USER: (3, "I"), c.ASSISTANT: (6, "II")}
        for (_, role, _), found in zip(here, faults):
            extra, then = 3 * (found == "truncated"), {}

            def offer(state, cost, audit):
                then[state] = min(then.get(state, (1 << 60, "")), (cost, audit))

            for state, (cost, audit) in label.items():
                offer(state, cost + 4, audit + "D")
                if found not in ("blank", "duplicate"):
                    offer(c.THEN[state], cost + 3 + extra, audit + "R")
                    if (state, role[:1]) in c.READ:
                        offer(c.READ[state, role[:1]], cost + extra, audit + "K")
            for state in (c.START, c.SYSTEM, c.ASSISTANT, c.USER):
                if state in then:
                    offer(c.THEN[state], then[state][0] + 3, then[state][1] + "I")
            label = then
        cost, audit = min(label[s] for s in (c.START, c.ASSISTANT) if s in label)
        said, left, state = [], iter(here), c.START
        for edit in audit:
            row = None if edit == "I" else next(left)
            if edit == "D":
                continue
            role = row[1] if edit == "K" else c.WANTED[state]
            said.append(f"{role}:{row[2] if row else ''}")
            state = c.READ[state, role[:1]] if edit == "K" else c.THEN[state]
        assert re.fullmatch("(s?(ua)+)?", "".join(s[0] for s in said))
        turns = [t for t, *_ in here if t is not None]
        out[conv] = {
            "conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{k: faults.count(k) for k in ("blank", "duplicate", "truncated")},
            "illegal": sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(here, here[1:])),
            "cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256("\n".join(said).encode()).hexdigest()}
    return out


def conversations(seed: int, sizes: dict) -> list[tuple]:
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut", "", " \n\t", None, "é. ", "x.\x85", "ok.\n"]
    return [(conv, None if draw.random() < 0.05 else draw.randint(0, 2 * size), draw.choice(["user", "assistant"] * 4 + ["system", "tool", "", None]),
             draw.choice(texts) if draw.random() < 0.3 else f"turn {draw.randint(0, 3 * size)}" + draw.choice([".", "!", ""]), draw.random() < 0.9)
            for conv, size in sizes.items() for _ in range(size)]


@pytest.mark.parametrize("partitions", [1, 7])
def test_conversations_short_long_and_split_over_tasks(spark, partitions):
    rows = conversations(1, {**{i: i % 9 + 1 for i in range(60)}, None: 5, 100: 1700, 101: 513, 102: 512})
    rows += [(200, 1, "user", "a.", False)] * 3 + [(201, 1, "user", "Same.", True)] * 1500
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("segment", F.lit("clash")).withColumn("rows", F.lit(1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        found = [r.asDict() for r in c.repair_conversations(frame).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    expected = plain(rows)
    assert len(found) == len(expected)
    for row in found:
        assert row == expected[row["conv_id"]]


def test_no_rows_and_very_long_texts(spark):
    assert c.repair_conversations(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, i, ("user", "assistant")[i % 2], "long " * 400_000 + f"{i}.", True) for i in range(6)]
    found = c.repair_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [r.asDict() for r in found] == [plain(rows)[1]]


def test_query_damages_by_code(spark, small):
    rows = []
    for r in spark.read.parquet(f"{small}/conversations.parquet").collect():
        code = zlib.crc32(f"{r.conv_id}:{r.turn}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", r.text) if code == 2 else r.text
        rows += [(r.conv_id, r.turn, "user" if code == 4 else r.role, text, code != 0)] * (2 if code == 3 else 1)
    found = {r.conv_id: r.asDict() for r in op12_conversations(spark, small).collect()}
    assert found == plain(rows)
