"""BPE encoding and decoding with an index of pair occurrences.

A task gathers the distinct words of its documents and encodes the new ones
together. All their symbols lie in one linked list; an index maps the rank of
every pair of neighbours that can be merged to all positions where the pair
stands. Ranks that occur are taken in ascending order: each position of the
pair that still stands is merged, and the two pairs that a merge creates are
entered into the lists of their ranks. Work is thus in proportion to merges,
not to words times ranks. Words, once encoded, are looked up.

Normalisation, word splitting and special tokens follow the vocabulary file.
Decoding without a decoder joins the tokens by single spaces.

Defined cases: null and empty texts have no ids and decode to the empty text;
special strings inside a text are special tokens; rows that share an id are
encoded each; the number of words kept by a task is bounded, the length of a
text is not.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stockline.llm.common import give_back, small_batches

#: Once a task keeps more encoded words than this, it starts anew with the next batch.
KEPT_WORDS = 150_000
#: From so many positions on, a pair is merged with array operations.
AT_ONCE = 100


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


class Bpe:
    """A word-end BPE vocabulary: splits, encodes and decodes."""

    def __init__(self, path: str) -> None:
        import regex

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, norms = spec["model"], (spec["normalizer"] or {}).get("normalizers", [])
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        if ([n["type"] for n in norms] != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]
                or steps[0]["behavior"] != "Removed" or not steps[0]["invert"] or steps[1]["use_regex"] or spec["decoder"]
                or model["type"] != "BPE" or model["dropout"] or model["ignore_merges"] or spec["post_processor"]):
            raise ValueError("this kind of vocabulary is not implemented")
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens with options are not implemented")
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        letters = byte_letters()
        self._inner = np.array([vocab[c] for c in letters], np.int32)
        self._last = np.array([vocab[c + end] for c in letters], np.int32)
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        self.pairs: list[tuple[int, int]] = []
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.ranks.setdefault((vocab[a], vocab[b]), len(self.made))
            self.pairs.append((vocab[a], vocab[b]))
            self.made.append(vocab[a + b])
        self._keys = np.array([a << 32 | b for a, b in self.ranks])
        self._key_ranks = np.array(list(self.ranks.values()))
        order = np.argsort(self._keys)
        self._keys, self._key_ranks = self._keys[order], self._key_ranks[order]
        # From this rank on, what a merge makes is only in pairs of higher ranks, so the order within a rank does not matter.
        first_use: dict[int, int] = {}
        for rank, pair in enumerate(self.pairs):
            for part in pair:
                first_use.setdefault(part, rank)
        self.settled = 1 + max((rank for rank, token in enumerate(self.made) if first_use.get(token, len(self.made)) <= rank), default=-1)
        pattern = steps[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")
        self.find = regex.compile(pattern).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def words(self, text: str) -> list[str]:
        """The words of a text in order; special tokens are words too."""
        if self.cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        out: list[str] = []
        for i, part in enumerate(self.cut.split(text)):
            if i % 2:
                out.append("\x00" + part)  # no plain word begins with this and goes on with letters
            else:
                out += self._plain(part)
        return out

    def _plain(self, text: str) -> list[str]:
        # Letter by letter, as the library does: a final sigma is no special case.
        return self.find(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Ids of each word, all words at once."""
        if not words:
            return []
        ranks, made, pairs = self.ranks, self.made, self.pairs
        coded = [w.encode("utf-8", "replace") for w in words]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        data = np.frombuffer(b"\0".join(coded) + b"\0", np.uint8)
        stops = np.cumsum(sizes + 1) - 1  # one place between words, so that no pair reaches over
        begun = self._inner[data]
        begun[stops - 1] = self._last[data[stops - 1]]
        begun[stops] = -1
        # Numpy reads and writes the same memory as the loops below.
        symbols, after, before = array("i", begun.tobytes()), array("i", range(1, len(data) + 1)), array("i", range(-1, len(data) - 1))
        s, nxt, prv = (np.frombuffer(x, np.int32) for x in (symbols, after, before))
        index: dict[int, array] = {}
        self._enter(index, s[:-1], s[1:], np.arange(len(data) - 1))
        active = list(index)
        heapq.heapify(active)
        while active:
            rank = heapq.heappop(active)
            left, right = pairs[rank]
            new, todo = made[rank], index.pop(rank)
            if len(todo) >= AT_ONCE and left != right and rank >= self.settled:
                p = np.unique(np.frombuffer(todo, np.int32))
                p = p[(s[p] == left)]
                p = p[s[nxt[p]] == right]
                q = nxt[p]
                s[p], s[q] = new, -2
                q = nxt[q]
                nxt[p], prv[q] = q, p
                a = prv[p]
                p_left = p[a >= 0]
                a = a[a >= 0]
                for r in self._enter(index, np.concatenate([s[a], s[p]]), np.concatenate([s[p_left], s[q]]), np.concatenate([a, p])):
                    heapq.heappush(active, r)
                continue
            todo = sorted(todo)
            for n, p in enumerate(todo):
                if symbols[p] != left:
                    continue
                q = after[p]
                if symbols[q] != right:
                    continue
                symbols[p], symbols[q] = new, -2
                q = after[p] = after[q]
                before[q] = p
                for a, b in ((before[p], p), (p, q)):
                    if a >= 0:
                        r = ranks.get((symbols[a], symbols[b]))
                        if r is not None:
                            if r in index:
                                index[r].append(a)
                            else:
                                index[r] = array("i", (a,))
                                heapq.heappush(active, r)
                if active and active[0] < rank:  # a vocabulary may rank a new pair before this one
                    index.setdefault(rank, array("i")).extend(todo[n + 1:])
                    heapq.heappush(active, rank)
                    break
        kept = s[s != -2]
        return [x[:-1].tolist() for x in np.split(kept, np.flatnonzero(kept == -1) + 1)[:-1]]

    def _enter(self, index: dict[int, array], lefts: np.ndarray, rights: np.ndarray, places: np.ndarray) -> list[int]:
        """Enter the places of pairs into the lists of their ranks; the ranks that had no list."""
        keys = lefts.astype(np.int64) << 32 | rights
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        known = (self._keys[at] == keys) & (lefts >= 0) & (rights >= 0)
        found, places = self._key_ranks[at[known]], places[known]
        order = np.argsort(found, kind="stable")
        found, places = found[order], places[order].astype(np.int32)
        if not len(places):
            return []
        cuts = np.flatnonzero(np.diff(found, prepend=-1)).tolist()
        fresh = []
        for a, b in zip(cuts, [*cuts[1:], len(places)], strict=True):
            r = int(found[a])
            if r in index:
                index[r].frombytes(places[a:b].tobytes())
            else:
                index[r] = array("i", places[a:b].tobytes())
                fresh.append(r)
        return fresh

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


@functools.cache
def _load(path: str) -> Bpe:
    return Bpe(path)


def encode_decode(documents: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)`` of every row; ``ids`` are little-endian unsigned 32-bit integers."""

    def run(batches):
        bpe, known, pool = _load(vocabulary), {}, {}
        for batch in small_batches(batches, 3 << 20):
            if len(pool) > KEPT_WORDS:
                known.clear()
                pool.clear()
                give_back()
            # Every word is held once, however often it occurs; its ids are kept, its decoded text follows from them.
            texts = [list(map(pool.setdefault, words, words)) for words in map(bpe.words, (x or "" for x in batch.column(1).to_pylist()))]
            new = [w for w in pool if w not in known]
            plain = [w for w in new if w[0] != "\x00" or w[1:] not in bpe.special]
            for word, ids in zip(plain, bpe.encode_words(plain), strict=True):
                known[word] = array("I", ids).tobytes()
            for word in set(new).difference(plain):
                known[word] = array("I", (bpe.special[word[1:]],)).tobytes()
            ids, decoded = [], []
            for words in texts:
                ids.append(b"".join(map(known.__getitem__, words)))
                decoded.append(bpe.decode(memoryview(ids[-1]).cast("I")))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids", "decoded"])
        known.clear()
        pool.clear()
        give_back()

    own = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, "doc_id long, n_tokens long, ids binary, decoded string")
