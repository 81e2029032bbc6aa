"""Personal data that the fitted model adds: what the sample, and what the proposals are."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from stockline.llm import personal


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def numbers(draw, count):
    """Card numbers: half of them pass the check."""
    while count:
        d = "".join(draw.choice("0123456789") for _ in range(16))
        if luhn(d) == (count % 2 == 0):
            yield d
            count -= 1


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(3)
    part = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    out = []
    for card in numbers(draw, 600):
        phone = f"+1 ({part(3)}) {part(3)}-{part(4)}"
        ip = ".".join(str(draw.randrange(1, 256)) for _ in range(4))
        out.append(f"from {ip} and {card} or {phone} to {part(7)} by u{part(3)}@host{part(2)}.org on")
    return out


def table(spark, texts, times=1):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return frame.select(F.explode(F.sequence(F.lit(1), F.lit(times))).alias("n"), "*").selectExpr("n * 100000 + doc_id as doc_id", "text")


def test_more_rows_of_the_same_kind_do_not_change_thresholds(spark, texts):
    fits = [personal.fit_spans(personal.candidates(table(spark, texts, n), ["doc_id"]), sample=800).thresholds for n in (1, 7)]
    assert fits[0] == fits[1] and {0, 1, 3} <= set(fits[0])


@pytest.mark.parametrize(("text", "want"), [
    ("see 7536784127813050 4845168114407329 here", ["card 7536784127813050", "card 4845168114407329"]),
    ("see 2353820953013749 4550997810720808 here", ["card 4550997810720808"]),  # the first fails the check of cards
    ("see +1 (826) 555-4081 190.137.223.204 here", ["phone +1 (826) 555-4081", "ip 190.137.223.204"]),
    ("see +1 (843) 555-7672 170.106.47.218 here", ["phone +1 (843) 555-7672", "ip 170.106.47.218"])])
def test_neighbouring_numbers_are_told_apart(together, text, want):
    assert [f"{personal.KINDS[k]} {text[a:b]}" for a, k, b in together[text]] == want


@pytest.fixture(scope="module")
def together(spark, texts):
    cases = [m.args[1] for m in test_neighbouring_numbers_are_told_apart.pytestmark if m.name == "parametrize"][0]
    body = [t for t, _ in cases]
    frame = table(spark, texts + body)
    found = personal.find_personal(frame, ["doc_id"]).filter(F.col("doc_id") >= 100000 + len(texts)).collect()
    return {body[r["doc_id"] - 100000 - len(texts)]: [tuple(s) for s in r["spans"]] for r in found}


def test_long_runs_have_parts_in_proportion(spark):
    frame = table(spark, ["12 345 " * n for n in (500, 1000)])
    sizes = {r["doc_id"]: r["n"] for r in personal.candidates(frame, ["doc_id"]).select("doc_id", F.size("wide").alias("n")).collect()}
    assert 0 < sizes[100001] < 2.1 * sizes[100000]


def test_every_distinct_vector_counts(spark, texts):
    found = personal.candidates(table(spark, texts), ["doc_id"])
    each = found.select(F.explode("wide").alias("p")).filter("p.label is not null")
    rows = personal._weighted(found, sample=80)
    want = each.selectExpr("explode(if(p.label = 1, array(p.f, p.plain), array(p.f))) as f", "p.label").distinct()
    assert want.count() > 80 and want.exceptAll(rows.select("f", "label").distinct()).isEmpty()
    values = {r["y"]: r["n"] for r in each.groupBy(F.col("p.label").alias("y")).agg(
        F.count_distinct("p.f", "p.plain", "p.v").alias("n")).collect()}
    shown = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.sum("shown").alias("n")).collect()}
    assert shown == {0: values[0], 1: 2 * values[1]}
    assert rows.agg(F.sum("weight")).first()[0] <= 2 * 80
