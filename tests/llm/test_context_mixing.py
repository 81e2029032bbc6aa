"""Scores by context mixing against a plain computation, bit by bit."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockline.llm import context_mixing as m
from stockline.llm.queries import op11_context_mixing

SCHEMA = "doc_id long, text string"


def symbols(text: str | None) -> list[int]:
    return [b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()] + [m.END]


def contexts(text: str | None):
    """For every byte: the byte, and what stands before it, by order."""
    padded = [0] * m.ORDERS + symbols(text)
    for at in range(m.ORDERS, len(padded)):
        yield padded[at], [tuple(padded[at - k:at]) for k in range(1, m.ORDERS + 1)]


def plain_score(text: str | None, counts: dict[tuple, Counter]) -> float:
    """log10 of the probability of a text, one bit after the other; rounded like the operator where cells could change."""
    weights = m.first_weights()
    squares = [[1e-3] * m.ORDERS for _ in weights]
    centres = [1 / (1 + math.exp(-(level + 0.5) / 2)) for level in range(m.LEVELS)]
    right, total = [c * m.PRIOR_BITS for c in centres], [m.PRIOR_BITS] * m.LEVELS
    coded, rows, done, step = 0.0, list(contexts(text)), 0, m.FIRST_STEP
    while done < len(rows):
        slopes, seen = Counter(), []
        for byte, before in rows[done:done + step]:
            found = [counts.get(c, Counter()) for c in before]
            sizes = [sum(f.values()) for f in found]
            level = lambda n: 0 if n == 0 else 1 if n < 4 else 2 if n < 32 else 3
            gate = 4 * level(sizes[-1]) + level(sizes[-2])
            for bit in range(8):
                odds = []
                for f in found:
                    above = sum(n for b, n in f.items() if b >> (8 - bit) == byte >> (8 - bit))
                    same = sum(n for b, n in f.items() if b >> (7 - bit) == byte >> (7 - bit))
                    value = math.log((same + m.UNSEEN) / (above - same + m.UNSEEN))
                    odds.append(np.float32(max(-127, min(127, round(value * m.SCALE)))) * np.float32(1 / m.SCALE))
                mixed = weights[gate, 0] * odds[0]
                for w, o in zip(weights[gate, 1:], odds[1:]):
                    mixed = mixed + w * o
                mixed = max(-14.0, min(14.0, float(mixed)))
                wrong = 1 / (1 + math.exp(mixed))
                cell = min(int(abs(mixed) * 2), m.LEVELS - 1)
                trust = right[cell] / total[cell]
                coded += math.log10((1 - wrong + (trust if mixed > 0 else 1 - trust)) / 2)
                seen.append((cell, mixed > 0))
                for order, o in enumerate(odds):
                    slopes[gate, order] += wrong * float(o)
        for (gate, order), slope in slopes.items():
            squares[gate][order] += slope * slope
            weights[gate, order] += m.RATE * slope / math.sqrt(squares[gate][order])
        for cell, hit in seen:
            total[cell] += 1
            right[cell] += hit
        done, step = done + step, min(2 * step, m.LAST_STEP)
    return coded


def words(text: str | None) -> list:
    lower = re.sub("[A-Z]", lambda a: a[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + [None]


def taught(doc_id) -> bool:
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 10 != 0


def check(found: list[dict], rows: list[tuple], scores: bool = True) -> None:
    tokens, pairs = Counter(), {}
    for doc_id, text in rows:
        if taught(doc_id):
            tokens.update(words(text))
            for byte, before in contexts(text):
                for c in before:
                    pairs.setdefault(c, Counter())[byte] += 1
    total, distinct = sum(tokens.values()), len(tokens)
    assert len(found) == len(rows)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["n_tokens"], r["base_score"])
    expected = []
    for doc_id, text in rows:
        here = words(text)
        expected.append({
            "doc_id": doc_id, "held_out": not taught(doc_id), "n_tokens": len(here), "n_known": sum(tokens[w] > 0 for w in here),
            "train_tokens": total, "base_score": math.fsum(math.log10((tokens[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in here),
            "text": text})
    for got, want in zip(sorted(found, key=key), sorted(expected, key=key)):
        text = want.pop("text")
        assert got["base_score"] == pytest.approx(want["base_score"], rel=1e-12, abs=1e-12)
        assert {k: got[k] for k in want if k != "base_score"} == {k: v for k, v in want.items() if k != "base_score"}
        if scores:
            want = plain_score(text, pairs)
            assert got["score"] == pytest.approx(want, rel=1e-4, abs=1e-4)
            assert got["bits_per_byte"] == pytest.approx(-got["score"] / math.log10(2) / len(symbols(text)), rel=1e-9)


def learn():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0, F.lit(True))


def run(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit("clash"), "chunk": F.lit(-5), "kind": F.lit(None).cast("string")})
    return [r.asDict() for r in m.score_texts(frame, learn()).collect()]


def test_scores_of_small_texts_with_nulls_ties_and_repeats(spark):
    draw = random.Random(8)
    pieces = ["the ", "cat ", "sat. ", "É", "\n", "\x00", "漢字 ", "THE ", "a", "\x0b"]
    rows = [(i, "".join(draw.choice(pieces) for _ in range(draw.randint(0, 40)))) for i in range(60)]
    rows += [(None, "no id"), (None, None), (7, "twice"), (7, "twice"), (3, ""), (61, "the cat " * 300), (29, "xyz")]
    check(run(spark, rows), rows)


def test_no_rows_and_nothing_to_learn_from(spark):
    assert run(spark, []) == []
    held = next(i for i in range(1000) if not taught(i))
    check(run(spark, [(held, "a b")]), [(held, "a b")])


def test_longest_texts_do_not_move_the_scores_of_others(spark):
    rows = [(i, f"short text {i}") for i in range(20)] + [(100, "long text " * 400_000)]
    found = run(spark, rows)
    check(found, rows, scores=False)
    alone = {r["doc_id"]: r for r in found}
    assert alone[100]["bits_per_byte"] < 0.1 < alone[1]["bits_per_byte"]


def test_probabilities_of_all_next_bytes_sum_to_one():
    """The odds of a context's bytes are those of one distribution."""
    keys = (np.uint64(5) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    odds = m.node_odds(keys, np.arange(256) % 7)[:, :8].astype(float) / m.SCALE
    assert np.exp(-np.log1p(np.exp(-odds)).sum(axis=1)).sum() == pytest.approx(1, abs=0.05)  # odds are rounded


def test_query_on_given_documents(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    found = [r.asDict() for r in op11_context_mixing(spark, small).collect()]
    check(found, rows, scores=False)
    held = [r for r in found if r["held_out"]]
    assert sum(r["bits_per_byte"] for r in held) / len(held) < 4.5  # a byte of these texts has about 4.6 bits without context
