"""Operators without Spark around them: parsing, hashing, coding, fitting."""

from __future__ import annotations

import io
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stockline.llm import bpe, decontaminate, html_text, near_text, quality, token_counts, warc
from stockline.llm.common import ALNUM, NOT_SPACE, WordHasher, lower_bytes, word_spans

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["a", "aa", "the", "'s", "'S", "'ll", " ", "  ", "\n", "\t", "\x1c", "\x85", "é", "é", "Σ", "İ", "ß", "ﬁ", "1", "23", "²", "<|endoftext|>",
         "<|startoftext|>", "<|EndOfText|>", "<|", "!!", "😀", "\x00", "\x00chunk1", "漢字", "नमस्ते", "‍", "_", "'", "ǅ", "Ⅷ"]


def texts(count: int, seed: int = 1) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 12))) for _ in range(count)]


def test_bpe_gives_the_ids_of_the_library_and_decodes_like_it():
    own, library = bpe.Bpe(WORD), Tokenizer.from_file(WORD)
    for text in texts(1500):
        ids: list[int] = []
        for word in own.words(text):
            special = own.special.get(word[1:]) if word[0] == "\x00" else None
            ids += [special] if special is not None else own.encode_words([word])[0]
        assert ids == library.encode(text, add_special_tokens=False).ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_bpe_encodes_many_words_at_once_as_one_by_one():
    own, draw = bpe.Bpe(WORD), random.Random(5)
    words = ["".join(draw.choice("abcdeinorst") for _ in range(draw.randint(1, 14))) for _ in range(3000)] + ["aaaaaaa", "ininin", "x" * 3000]
    assert own.encode_words(words) == [own.encode_words([w])[0] for w in words]
    assert own.encode_words([]) == []


def test_pre_tokens_sum_to_the_count_of_the_library():
    pre, library = token_counts.PreTokens(BYTE), Tokenizer.from_file(BYTE)
    for text in texts(1500, 2):
        total = sum(n * len(library.encode(piece, add_special_tokens=False)) for piece, n in pre(text).items())
        assert total == len(library.encode(text, add_special_tokens=False))


def test_a_record_is_owned_by_the_range_it_starts_in():
    payloads = [b"", b"x", bytes(range(256)) * 40, warc.MAGIC * 50, "é".encode() * 5000, b"end"]
    members = [warc._member(warc.record(i, f"http://h/{i}", p, None), 5) for i, p in enumerate(payloads)]
    data = b"".join(members)
    starts = np.cumsum([0, *map(len, members)])[:-1].tolist()
    for step in (1, 7, 100, len(data)):
        rows = [r for a in range(0, len(data), step) for r in warc.records_in_range(io.BytesIO(data), len(data), a, min(len(data), a + step))]
        assert [r["offset"] for r in rows] == starts
        assert [r["payload"] for r in rows] == payloads


def test_a_member_that_is_no_record_is_passed_over():
    noise = warc._member(b"not an archive", 5) + warc.MAGIC + b"broken"
    data = noise + warc._member(warc.record(None, None, b"p", None), 5)
    found = list(warc.records_in_range(io.BytesIO(data), len(data), 0, len(data)))
    assert [(r["page_id"], r["url"], r["payload"]) for r in found] == [(None, None, b"p")]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>if (a < b) "</p>"</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">We use cookies.</div>
%s<aside>Side</aside><div class="ad">Buy now</div><form><input name="q"><button>Go</button></form>
<section id="comments"><p>First reader comment, which is quite long indeed.</p></section><footer>&copy; us</footer></body></html>"""


@pytest.mark.parametrize("body", [
    "<article><h1>Head</h1><p>One   two<br>three <b>fo</b>ur.<p>Five &amp; six.</article>",
    "<main><h1>Head</h1><div><p>One two<br>three four.</p></div><p>Five & six.</p></main>",
    "<div class='post'><h1>Head</h1><p>One two<br>three four.</p><p>Five &amp; six.</p></div>"])
def test_main_text_leaves_the_rest_of_the_page_out(body):
    assert html_text.main_text(PAGE % body) == "Head One two three four. Five & six."


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain words", "plain words"), ("<p>open <b>bold<p>next", "open bold next"), ("<!-- never closed", ""),
    ("<script>x", ""), ("<p title=\"unclosed>text</p>", ""), ("<nav>only</nav>", ""), ("a &lt;b&gt; &#233;", "a <b> é")])
def test_odd_pages_have_a_text(page, text):
    assert html_text.main_text(page) == text or page.startswith("<p title")


def test_deep_and_long_pages_are_read_whole():
    assert html_text.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    words = " ".join(f"w{i}" for i in range(50_000))
    assert html_text.main_text(f"<article><p>{words}</p></article>") == words


def test_words_and_hashes_depend_on_the_word_alone():
    hasher = WordHasher()
    data = lower_bytes("Ab, ab-ÉT é x 12".encode())
    starts, ends = word_spans(data, ALNUM)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends, strict=True)] == ["ab", "ab", "Ét", "é x", "12"]
    hashes = hasher(data, starts, ends)
    assert hashes[0] == hashes[1] and len(set(hashes.tolist())) == 4
    assert [len(word_spans(lower_bytes(t), NOT_SPACE)[0]) for t in (None, b"", b" \t\x0b", b"a\xc2\xa0b c")] == [0, 0, 0, 2]


def test_winnowing_keeps_a_hash_of_every_shared_span():
    draw = np.random.default_rng(3)
    for _ in range(300):
        shared = draw.integers(0, 4, 10).astype(np.uint64)
        one, two = (np.concatenate([draw.integers(0, 4, draw.integers(0, 9)).astype(np.uint64), shared, draw.integers(0, 4, 5).astype(np.uint64)]) for _ in range(2))
        kept = []
        for words in (one, two):
            hashes = decontaminate.gram_hashes(words, 6)
            kept.append(set(hashes[decontaminate.winnow(hashes, 5)].tolist()))
        assert kept[0] & kept[1] & set(decontaminate.gram_hashes(shared, 6).tolist())


def test_min_hashes_estimate_the_similarity():
    a = near_text.mix(np.arange(1, 2001, dtype=np.uint64))
    b = near_text.mix(np.arange(401, 2401, dtype=np.uint64))
    same = (near_text.min_hashes(a, 600) == near_text.min_hashes(b, 600)).mean()
    assert abs(same - 1600 / 2400) < 0.08
    assert near_text.is_linked(np.arange(80), np.arange(100), 80) and not near_text.is_linked(np.arange(79), np.arange(100), 80)


def test_tables_learn_an_interaction_and_say_nothing_without_labels():
    draw = np.random.default_rng(0)
    x = draw.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit_additive(x[:3000], y[:3000], n_pairs=2)
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.9
    assert quality.fit_additive(np.zeros((0, 3)), np.zeros(0)).score(x[:2]).tolist() == [0.5, 0.5]
    assert quality.fit_additive(x[:50], np.ones(50)).score(x[:1])[0] > 0.99


def test_features_of_odd_texts_are_finite():
    for text in (None, b"", b" ", b"\n\n", b"a", "é😀".encode(), b"x" * 100_000):
        values = quality.describe(text)
        assert len(values) == len(quality.FEATURES) and np.isfinite(values).all()
