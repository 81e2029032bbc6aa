"""Operators on small tables: nulls, empty texts and tables, repeated rows, clashing columns, and brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from stockline.llm import bpe, decontaminate, html_text, near_text, near_vectors, personal, quality, token_counts, url_filter, warc
from stockline.llm.queries import URL_RULES
from stockline.session import fresh_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


@pytest.fixture(scope="module")
def odd(spark):
    """Documents with nulls, empty and long texts, ties, repeated rows, an id with two texts, and columns named like ours."""
    long = " ".join(f"word{i % 700}" for i in range(30_000))
    rows = [(1, "Alpha beta gamma delta", "en"), (2, "alpha BETA gamma delta", "en"), (3, None, None), (4, "", ""), (5, "   \n", "x"), (6, long, "en"),
            (None, "no id at all", "en"), (1, "Alpha beta gamma delta", "en"), (7, "one", "en"), (7, "two", "en"), (8, "<|endoftext|> İΣ é", "tr")]
    return spark.createDataFrame([(i, t, k, "s", 1) for i, t, k in rows], "doc_id long, text string, key string, spans string, n_words int")


def test_archives_round_trip(spark):
    pages = spark.createDataFrame(
        [(3, "http://a/x y", "same"), (2, None, "same"), (2, None, "same"), (None, "u", "same"), (5, "u", None), (6, "u", ""), (7, "u", "é" * 9), (None, "u", "alone")],
        "page_id long, url string, html string").withColumn("refers_to", pages_extra())
    files = warc.write_warc(pages, fresh_folder(spark, "warc"), file_bytes=400)
    rows = sorted(map(tuple, warc.read_warc(spark, files, range_bytes=64).select("page_id", "payload_bytes", "record_type", "refers_to").collect()), key=str)
    assert rows == sorted([(3, 4, "revisit", 2), (2, 4, "response", None), (2, 4, "response", None), (None, 4, "revisit", 2), (5, 0, "response", None),
                           (6, 0, "revisit", 5), (7, 18, "response", None), (None, 5, "response", None)], key=str)
    kept = {r["page_id"]: r["payload"] for r in warc.read_warc(spark, files, with_payload=True).collect() if r["record_type"] == "response"}
    assert bytes(kept[7]).decode() == "é" * 9 and bytes(kept[5]) == b""
    big = warc.write_warc(pages, fresh_folder(spark, "warc"), min_revisit_bytes=5)
    assert warc.read_warc(spark, big).filter("record_type = 'revisit'").count() == 0
    none = warc.write_warc(pages.limit(0), fresh_folder(spark, "warc"))
    assert none == [] and warc.read_warc(spark, none).count() == 0


def pages_extra():
    from pyspark.sql import functions as F
    return F.lit("clash")


def test_verdicts_follow_rules_and_links(spark):
    link = "<a class=x href='{}'>t</a>".format
    pages = spark.createDataFrame(
        [(1, "http://Good.ORG/a?x", link("https://friend.net/")), (2, "http://bad.com/de/1", ""), (3, "http://farm.net/p", link("//bad.com/de/1") * 3 + link("/own")),
         (4, "http://friend.net/", None), (5, None, None), (6, "no scheme", ""), (7, "http://example.org/es/1", ""), (8, "http://org", ""), (9, "http://xorg/", ""),
         (10, "http://a.b.example.org/en/1#f", ""), (11, "http://bad.com/de/2", ""), (12, "http://bad.com/fr/", "")], "page_id long, url string, html string")
    rows = {r["page_id"]: r for r in url_filter.judge_urls(pages.selectExpr("*", "1 as host", "2 as rule"), URL_RULES).collect()}
    assert {i: r["verdict"] for i, r in rows.items() if r["verdict"] == "block"} == {2: "block", 3: "block", 7: "block", 10: "block", 11: "block"}
    assert [(rows[i]["host"], rows[i]["path"], rows[i]["rule"]) for i in (1, 5, 6, 8, 10)] == [
        ("good.org", "/a", "org/"), ("", "", None), ("", "", None), ("org", "", None), ("a.b.example.org", "/en/1", "example.org/en/1")]
    assert rows[4]["trust"] > 0 and rows[9]["rule"] is None
    assert url_filter.judge_urls(pages.limit(0), URL_RULES).count() == 0


@pytest.mark.parametrize("linkers", [1, 2, 1000])
def test_verdicts_of_linkers_do_not_depend_on_their_number(spark, linkers):
    """Hosts that link to a blocked host only are blocked, however many; one that links mostly to others is not."""
    import duckdb
    link = "<a href='{}'>t</a>".format
    to_bad = link("http://bad.com/de/1")
    rows = [(1, "http://bad.com/de/1", ""), (2, "http://mixed.net/", to_bad + link("http://fine.net/") * 8), (3, "http://fine.net/", ""),
            (4, "http://good.org/", link("http://liked.net/")), (5, "http://liked.net/", to_bad), (6, "http://far.net/", link("http://mixed.net/"))]
    rows += [(100 + n, f"http://farm{n}.net/", to_bad) for n in range(linkers)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in url_filter.judge_urls(pages, URL_RULES).collect()}
    assert {i for i, r in got.items() if r["verdict"] == "block"} == {1, *range(100, 100 + linkers)}
    assert got[100]["distrust"] == pytest.approx(1.0) and 0 < got[2]["distrust"] < 0.5 and got[5]["trust"] == pytest.approx(1.0)
    con = duckdb.connect()
    con.register("pages", pages.toArrow())
    assert {r[0]: tuple(r[1:]) for r in con.execute(url_filter.judge_sql(URL_RULES)).fetchall()} == {
        i: (r["host"], r["path"], r["rule"], r["verdict"]) for i, r in got.items()}


def test_pages_have_texts(spark):
    pages = spark.createDataFrame([(1, "u", "<p>a<p>b"), (1, "u", "<p>a<p>b"), (None, None, None)], "page_id long, url string, html string").selectExpr("*", "0 as text")
    assert sorted(map(tuple, html_text.extract_text(pages).collect()), key=str) == sorted([(1, "u", "a b", 3), (1, "u", "a b", 3), (None, None, "", 0)], key=str)


def test_passages_are_those_of_brute_force(spark, odd):
    draw, vocabulary = random.Random(4), [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([10, 25, 60, 1, 6, 9, 12])] + [(20, None), (21, "..."), (22, "alpha beta gamma delta"), (2, "Alpha, beta gamma delta!"), (None, "no id at all")]
    docs = []
    for i in range(60):
        source = (items[draw.randrange(7)][1]).split()
        a = draw.randrange(len(source))
        docs.append((100 + i, " ".join([text(draw.randrange(12)), *source[a:a + draw.randint(5, 40)], text(draw.randrange(12))])))
    docs += [(r["doc_id"], r["text"]) for r in odd.collect()]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'c' as row_key", "0 as hash")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in decontaminate.find_passages(frame, bench).collect()), key=str)
    want = []
    for doc_id, body in docs:
        w, hit, found = words(body), set(), set()
        for item, passage in items:
            p = words(passage)
            n = min(10, len(p))
            windows = {tuple(p[j:j + n]) for j in range(len(p) - n + 1)} if n else set()
            for j in range(len(w) - n + 1) if n else ():
                if tuple(w[j:j + n]) in windows:
                    hit.update(range(j, j + n))
                    found.add(item)
        want.append((doc_id, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    assert got == sorted(want, key=str)
    assert decontaminate.find_passages(frame.limit(0), bench).count() == 0
    assert decontaminate.find_passages(frame, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_counts_and_codes_are_those_of_the_library(spark, odd):
    word, byte = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    by_word, by_byte = Tokenizer.from_file(word), Tokenizer.from_file(byte)
    texts = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    got = sorted(map(tuple, token_counts.count_tokens(odd, byte).collect()), key=str)
    assert got == sorted(((i, len(t.encode()), len(by_byte.encode(t, add_special_tokens=False))) for i, t in texts), key=str)
    coded = sorted(((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in bpe.encode_decode(odd, word).collect()), key=str)
    want = [(i, by_word.encode(t, add_special_tokens=False).ids) for i, t in texts]
    assert coded == sorted(((i, ids, by_word.decode(ids, skip_special_tokens=False)) for i, ids in want), key=str)
    assert token_counts.count_tokens(odd.limit(0), byte).count() == bpe.encode_decode(odd.limit(0), word).count() == 0


def test_vectors_are_linked_as_by_brute_force(spark):
    draw = np.random.default_rng(2)
    base = draw.normal(size=(40, 16))
    x = np.concatenate([b + draw.normal(size=(n, 16)) * 0.25 for b, n in zip(base, [150, *draw.integers(1, 12, 39)], strict=True)]).astype(np.float32)
    rows = [(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(5000, [float(v) for v in x[3]]), (5001, None), (5002, []), (5003, [0.0] * 16), (5004, [float("nan")] * 16),
            (5005, [None] * 16), (5006, [1.0, 2.0]), (5007, [float("inf")] * 16), (None, [1.0] * 16)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as rep", "2 as value_")
    got = {r["vec_id"]: r for r in near_vectors.near_vectors(frame, block=32).collect()}
    ids, y = [*range(len(x)), 5000], np.concatenate([x, x[3:4]]).astype(float)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    close = y @ y.T >= 0.9
    want, have = close.sum() - len(y), sum(got[i]["n_links"] for i in ids)
    assert 0.9 * want <= have <= want  # recall of the index, and nothing but links
    assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(5001, 5008))
    assert got[5000]["component_id"] == got[3]["component_id"] and got[None]["n_links"] == 0
    assert near_vectors.near_vectors(frame.limit(0)).count() == 0


def test_an_id_with_several_vectors_has_a_row_for_each(spark):
    a, b, c, close = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0], [0.0, 0.1, 1.0]
    rows = [(1, a), (7, b), (7, c), (9, close), (20, a), (20, a), (21, [1.0, 1.0, 1.0]), (7, None)]
    found = near_vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found) == sorted(
        [(1, 2, 1, True), (7, 0, 7, True), (7, 1, 7, True), (9, 1, 7, False), (20, 2, 1, False), (20, 2, 1, False), (21, 0, 21, True), (7, 0, 7, True)])


def test_near_texts_are_grouped_as_by_brute_force(spark, odd):
    draw = random.Random(8)
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for i in range(40):
        body = [f"t{i}x{draw.randrange(300)}" for _ in range(60)]
        for _ in range(draw.randrange(1, 12 if i else 150)):
            copy = list(body)
            for _ in range(draw.randrange(5)):
                copy[draw.randrange(60)] = f"e{draw.randrange(10**6)}"
            texts.append((1000 + len(texts), " ".join(copy)))
    groups = [texts[30], texts[200], texts[-1]]
    texts += [(3000, groups[0][1]), (3000, groups[1][1]), (3001, groups[2][1]), (3001, "nothing like it"), *[groups[0]] * 50]
    sets = []
    for _, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(set(zip(w, w[1:], strict=False)) if len(w) > 1 else {tuple(w)} if w else set())

    def components(ids_link):
        up = list(range(len(texts)))

        def find(i):
            while up[i] != i:
                i = up[i]
            return i

        for n, (i, _) in enumerate(texts):
            for m in range(n):
                if i is not None and texts[m][0] is not None and find(n) != find(m) and sets[n] and sets[m] and (
                        ids_link and texts[m][0] == i or 100 * len(sets[n] & sets[m]) >= 80 * len(sets[n] | sets[m])):
                    up[find(n)] = find(m)
        least = {}
        for n, (i, _) in enumerate(texts):
            least[find(n)] = min(least.get(find(n), i), i) if i is not None else None
        return [least[find(n)] for n in range(len(texts))], [find(n) for n in range(len(texts))]

    frame = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 as rep", "2 as key")
    names, _ = components(True)
    found = near_text.near_groups(frame, shingle=2, block=16)
    got = sorted((tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=str)
    assert got == sorted(((i, len(s), c, i == c) for (i, _), s, c in zip(texts, sets, names, strict=True)), key=str)
    assert near_text.near_groups(frame.limit(0)).count() == 0
    names, groups = components(False)
    alone = near_text.near_groups(frame, shingle=2, block=16, ids_link=False).collect()
    assert sorted(((r["doc_id"], r["component_id"]) for r in alone), key=str) == sorted(((i, c) for (i, _), c in zip(texts, names, strict=True)), key=str)
    stand = {(r["doc_id"], r["row_key"]) for r in alone if r["chosen"] and r["n_shingles"] and r["doc_id"] is not None}
    assert len(stand) == len({g for (i, _), s, g in zip(texts, sets, groups, strict=True) if s and i is not None})


def test_stage_keeps_one_row_of_each_group(spark):
    from corpus_pipeline import near_copies
    text = lambda *w: " ".join(w)
    body = [f"w{i}" for i in range(60)]
    rows = [(5, text(*body)), (5, text(*body)), (2, text(*body[1:])), (2, "an other text of the same id here"), (9, "an other text of the same id here"),
            (None, text(*body)), (None, text(*body)), (11, None), (11, None), (12, "")]
    frame = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS)
    kept = sorted(((r["doc_id"], r["text"]) for r in near_copies(spark, frame, "").collect()), key=str)
    assert kept == sorted([(2, text(*body[1:])), (2, "an other text of the same id here"), *rows[5:]], key=str)
    again = sorted(((r["doc_id"], r["text"]) for r in near_copies(spark, frame.filter("doc_id = 5"), "").collect()), key=str)
    assert again == [rows[0]]


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def base_spans(text):
    def luhn(d):
        return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0
    out = []
    for k, (_, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            if (True, k == 1 and all(int(x) <= 255 for x in m[0].split(".")), 12 <= len(d) <= 19 and luhn(d), 9 <= len(d) <= 15)[k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_are_those_of_the_patterns(spark, odd):
    draw = random.Random(6)
    parts = ["a@b.c", "x.y@", "@", "é", "😀", ".", "-", "+", " ", "1", "255", "256", "4111 1111 1111 1111", "+1 (499) 555-6503", "10.0.0.1", "_", "%", "(", ")", "\n", "007"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 14))) for _ in range(400)]
    texts += ["a@b.c " * 700, "9" * 20_000, "a" * 50_000 + "@x.y", "1.2.3.4.5.6.7.8", "x@y.com%z@w.org", None, ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as base", "2 as spans", "3 as wide")
    found = personal.find_personal(frame, ["doc_id"]).collect()
    for row in found:
        want = base_spans(texts[row["doc_id"]] or "")
        assert [tuple(s) for s in row["base"]] == want
        assert {tuple(s) for s in row["spans"]} >= set(want)
    assert len(found) == len(texts)
    assert personal.find_personal(frame.limit(0), ["doc_id"]).count() == 0


def test_redaction_replaces_spans_and_nothing_else(spark):
    frame = spark.createDataFrame([("é a@b.c, 1.1.1.1!", [(2, 0, 7), (9, 1, 16)]), ("none", []), ("abcdef", [(0, 2, 4), (2, 3, 6)])],
                                  "t string, spans array<struct<start: int, kind: int, end: int>>")
    assert [r[0] for r in frame.select(personal.redacted("t", "spans")).collect()] == ["é [EMAIL], [IP]!", "none", "[CARD]"]


def test_quality_learns_from_labels_and_scores_all(spark, odd):
    rows = [(i, f"plain text number {i} of words. " * 5 if i % 3 else "JUNK!! " * (5 + i % 7), "s") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(0, 300, 2)] + [(None, 1), (4, None)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.score_quality(docs, labels).collect()}
    assert all(got[i]["predicted"] == int(i % 3 > 0) for i in range(300))
    assert quality.good_documents(docs, labels).columns == docs.columns
    assert quality.good_documents(docs, labels).count() == 200
    assert quality.score_quality(odd, labels.limit(0)).filter("score between 0 and 1").count() == odd.count()
    assert quality.score_quality(docs.limit(0), labels).count() == 0


def test_the_stages_run_on_odd_and_on_no_documents(spark, odd, tmp_path):
    folder = str(tmp_path / "tables")
    odd.selectExpr("doc_id", "text", "key as lang", "spans as source", "cast(n_words as long) as n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "word0 word1 word2 word3 word4 word5 word6 word7 word8 word9")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()}
    assert 6 not in rows and 2 not in rows and {1, 3, 4, None} <= rows
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0


def test_all_corpus_queries_are_registered():
    names = list(__spark_entry__.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert hashlib.sha256(b"").hexdigest() and not set(__spark_entry__.oracle_sql()) - set(names)
