"""Language-model scores: context predictors for every bit, mixed online, from counts over a whole corpus.

A text is its UTF-8 bytes with A-Z turned into a-z, and an end mark (0xFF). Each byte is eight binary decisions. A
predictor of order k gives the odds of a decision from what followed the hash of the last k bytes in the training texts.
A logistic mixer adds the predictors' log odds with weights that a gate selects (how often the two longest contexts
occurred), and moves the weights along the gradient of the coding cost while it reads the text, after blocks of
64, 128, ... 4096 bytes. A second map refines the mixed odds: per level of confidence it keeps how often the mixer was
right in this text, and the mean of both is the probability. Weights and map start anew in every text, so a score
depends on the text and the training corpus only.

Counts come from all training texts, with no cap: tasks count each context and following byte once per chunk of rows, the counts of
a context meet in the bucket of its hash, and each chunk gets the odds of its own contexts back. What moves is
one entry per chunk and distinct context, about a hundredth of the bytes, and grows with the corpus. A context in
a third of all texts has one entry per chunk like any other; buckets are read as streams. Words, for the base score, are counted and looked up
in the same way by 64-bit hashes (two of a billion different words share one with a chance of 0.03).

Defined cases: a null text is empty, an empty text has the end mark as its only token, repeated rows and ids are rows of
their own, an empty table gives no rows. Texts of any length are scored whole. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stockline.llm.common import NOT_SPACE, WordHasher, give_back, lower_bytes, mix, small_batches, stored

ORDERS = 4
END = 0xFF
END_KEY = np.uint64(0xFFFFFFFFFFFFFFFF)
CONTEXTS, WORDS = 0, 1
WIDTH = 9  # eight log odds and the size of the context
SCALE = 12.0  # steps per unit of log odds
UNSEEN = 0.1  # added to both sides of a decision
BLOCK_BYTES = 1 << 20  # texts looked at together
MIX_BYTES = 64 << 10  # texts mixed together
FIRST_STEP, LAST_STEP = 64, 4096
RATE = 0.04
LEVELS = 16  # of confidence, half a unit of log odds each
PRIOR_BITS = 48.0
TABLE_KEYS = 1 << 20


class Block:
    """Texts laid out with their contexts; ids of an order number the distinct pairs of context and byte."""

    def __init__(self, texts: Sequence[bytes]) -> None:
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        self.firsts = np.cumsum(sizes + ORDERS) - sizes
        data = np.zeros(int((sizes + ORDERS).sum()), dtype=np.uint8)
        flat = np.zeros(len(data), dtype=bool)
        for first, size, text in zip(self.firsts, sizes, texts):
            data[first:first + size - 1] = lower_bytes(text)
            data[first + size - 1] = END
            flat[first:first + size] = True
        self.sizes, self.data = sizes, data
        self.at = np.flatnonzero(flat)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])

    def orders(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per order: keys of the distinct pairs and, for every scored byte, the number of its pair."""
        ids, keys = self.data.astype(np.int32), mix(np.arange(1, 257, dtype=np.uint64))
        byte = self.data.astype(np.int64)
        for order in range(1, ORDERS + 1):
            codes = np.empty(len(ids), dtype=np.int64)
            codes[0] = byte[0]
            codes[1:] = (ids[:-1].astype(np.int64) << 8) | byte[1:]
            if len(keys) << 8 <= 1 << 23:
                seen = np.zeros(len(keys) << 8, dtype=bool)
                seen[codes] = True
                found = np.flatnonzero(seen)
                number = np.zeros(len(seen), dtype=np.int32)
                number[found] = np.arange(len(found), dtype=np.int32)
                ids = number[codes]
            else:
                numbers, found = pd.factorize(codes)
                ids = numbers.astype(np.int32)
            keys = (mix(keys[found >> 8] + np.uint64(order)) << np.uint64(8)) | (found & 255).astype(np.uint64)
            yield keys, ids[self.at]

    def words(self, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text number of every word."""
        inside = np.zeros(len(self.data) + 2, dtype=np.int8)
        inside[self.at + 1] = NOT_SPACE[self.data[self.at]]
        inside[self.firsts + self.sizes] = 0  # end marks, shifted by one
        turns = np.diff(inside)
        starts, ends = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        return hasher(self.data, starts, ends), np.searchsorted(self.firsts, starts, side="right") - 1


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[:len(keys)])
    return keys[firsts], np.add.reduceat(counts, firsts) if len(firsts) else counts[:0]


class Tally:
    """Counts by key, kept as sorted arrays."""

    def __init__(self, most: int = 1 << 21) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size, self.most = 0, most

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.size += len(keys)
        if self.size > self.most:
            whole = self.whole()
            self.parts, self.size, self.most = [whole], len(whole[0]), max(self.most, 2 * len(whole[0]))

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return summed(np.concatenate([k for k, _ in self.parts]), np.concatenate([c for _, c in self.parts]))


def node_odds(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each pair of context and byte (sorted keys): log odds of its eight decisions, and the size of its context.

    The counts below a node of the byte's binary tree are those of a range of keys.
    """
    running = np.concatenate([[0], np.cumsum(counts)])
    below = np.empty((len(keys), 9))
    for depth in range(9):
        span = np.uint64((1 << (8 - depth)) - 1)
        low = keys & ~span
        below[:, depth] = running[np.searchsorted(keys, low | span, side="right")] - running[np.searchsorted(keys, low)]
    odds = np.log((below[:, 1:] + UNSEEN) / (below[:, :-1] - below[:, 1:] + UNSEEN))
    out = np.empty((len(keys), WIDTH), dtype=np.int8)
    out[:, :8] = np.clip(np.rint(odds * SCALE), -127, 127)
    out[:, 8] = np.minimum(np.ceil(np.log2(below[:, 0] + 1)), 100)  # bits of the count
    return out


_GATE = np.array([0, 1, 1, 2, 2, 2] + [3] * 100, dtype=np.int32)  # unseen, up to 3, up to 31, more
GATES = 16


def first_weights() -> np.ndarray:
    """Weights by gate: contexts that were seen often count, shorter ones where the longest are rare."""
    longest, second = np.divmod(np.arange(GATES), 4)
    out = np.empty((GATES, ORDERS), dtype=np.float32)
    out[:, :] = 0.15
    out[:, -1] = np.array([0.0, 0.35, 0.5, 0.65])[longest]
    out[:, -2] = np.array([0.1, 0.4, 0.5, 0.4])[second]
    out[:, -3] = np.where(second < 2, 0.4, 0.2)
    return out


class Mixer:
    """Mixes and refines the odds of many texts at once, each with weights and map of its own."""

    def __init__(self, texts: int) -> None:
        self.weights = np.tile(first_weights(), (texts, 1))
        self.squares = np.full(self.weights.shape, 1e-3)
        middle = 1 / (1 + np.exp(-(np.arange(LEVELS) + 0.5) / 2))
        self.right = np.tile(middle * PRIOR_BITS, texts)
        self.total = np.full(texts * LEVELS, PRIOR_BITS)

    def cost(self, lanes: np.ndarray, gate: np.ndarray, inputs: list[np.ndarray], texts: int) -> np.ndarray:
        """log2 of the probability of the bytes, summed by text; ``inputs`` are the log odds of their bits, by order."""
        slot = lanes * GATES + gate
        mixed = self.weights[slot, 0][:, None] * inputs[0]
        for order in range(1, ORDERS):
            mixed += self.weights[slot, order][:, None] * inputs[order]
        np.clip(mixed, -14, 14, out=mixed)
        wrong = np.exp(mixed)
        wrong += 1
        np.reciprocal(wrong, out=wrong)
        # A cell of the map is a level and whether the mixer was right: its chance is known, the bit tells which of the two.
        cell = np.abs(mixed)
        cell *= 2
        np.minimum(cell, LEVELS - 1, out=cell)
        cell = cell.astype(np.intp)
        cell <<= 1
        cell += mixed > 0
        cell += (lanes * (2 * LEVELS))[:, None]
        trust = self.right / self.total
        chance = np.stack([1 - trust, trust], axis=1).ravel().astype(np.float32)[cell]
        chance -= wrong
        chance += 1  # twice the mean of both
        pairs = chance[:, :4] * chance[:, 4:]
        pairs = pairs[:, :2] * pairs[:, 2:]
        bits = np.bincount(lanes, np.log2(pairs[:, 0].astype(np.float64) * pairs[:, 1]) - 8, texts)
        for order in range(ORDERS):
            slope = np.bincount(slot, np.einsum("ij,ij->i", wrong, inputs[order]), len(self.weights))
            self.squares[:, order] += slope * slope
            self.weights[:, order] += RATE * slope / np.sqrt(self.squares[:, order])
        seen = np.bincount(cell.ravel(), minlength=2 * len(self.total)).reshape(-1, 2)
        self.total += seen.sum(axis=1)
        self.right += seen[:, 1]
        return bits


def text_bits(sizes: np.ndarray, offsets: np.ndarray, numbers: list[np.ndarray], odds: list[np.ndarray]) -> np.ndarray:
    """log2 of the probability of each text; ``numbers`` of its bytes select rows of ``odds``, by order."""
    total = np.zeros(len(sizes))
    logits = [o[:, :8].astype(np.float32) * np.float32(1 / SCALE) for o in odds]
    gates = _GATE[odds[-1][:, 8]][numbers[-1]] * 4 + _GATE[odds[-2][:, 8]][numbers[-2]]
    group, filled = [], 0
    for text in range(len(sizes) + 1):
        if text == len(sizes) or (filled and filled + sizes[text] > MIX_BYTES):
            chosen = np.array(group)
            mixer, done, step = Mixer(len(chosen)), 0, FIRST_STEP
            while True:
                active = np.flatnonzero(sizes[chosen] > done)
                if not len(active):
                    break
                taken = np.minimum(sizes[chosen[active]] - done, step)
                lanes = np.repeat(active, taken)
                inside = np.arange(len(lanes)) - np.repeat(np.cumsum(taken) - taken, taken)
                at = offsets[chosen[lanes]] + done + inside
                total[chosen] += mixer.cost(lanes, gates[at], [o.take(n[at], axis=0, mode="clip") for n, o in zip(numbers, logits)], len(chosen))
                done, step = done + step, min(2 * step, LAST_STEP)
            group, filled = [], 0
        if text < len(sizes):
            group.append(text)
            filled += sizes[text]
    return total


def row_sums(owners: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Sums by row of values in row order, through sums of up to 512 so that rounding does not add up."""
    part = owners + np.arange(len(owners)) // 512
    firsts = np.flatnonzero(np.diff(part, prepend=-1))
    return np.bincount(owners[firsts], np.bincount(part, values)[part[firsts]], rows)


def _blocks(batches) -> Iterator[tuple[int, list[dict]]]:
    """Rows of one chunk, cut at about ``BLOCK_BYTES`` of text; other rows come alone."""
    held, size = [], 0
    for batch in small_batches(batches, BLOCK_BYTES):
        for row in batch.to_pylist():
            if row["text"] is None or held and (held[0]["chunk"] != row["chunk"] or size + len(row["text"]) > BLOCK_BYTES):
                if held:
                    yield held[0]["chunk"], held
                held, size = [], 0
            if row["text"] is None:
                yield row["chunk"], [row]
                continue
            held.append(row)
            size += len(row["text"])
    if held:
        yield held[0]["chunk"], held


_COUNTS = "kind int, bucket long, chunk long, keys binary, counts binary"
_ARROW_COUNTS = pa.schema([("kind", pa.int32()), ("bucket", pa.int64()), ("chunk", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _asked(buckets: int):
    """What a chunk of rows counts, dealt to buckets; keys that only other rows hold have the count 0."""
    def cut(kind: int, chunk: int, tally: Tally) -> Iterator[pa.RecordBatch]:
        keys, counts = tally.whole()
        bucket = ((keys >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rows = [{"kind": kind, "bucket": b, "chunk": chunk, "keys": keys[order[edges[b]:edges[b + 1]]].tobytes(),
                 "counts": counts[order[edges[b]:edges[b + 1]]].tobytes()} for b in np.flatnonzero(np.diff(edges)).tolist()]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW_COUNTS)

    def run(batches):
        current, tallies, hasher = None, (Tally(), Tally()), WordHasher()
        for chunk, rows in _blocks(batches):
            if current is not None and chunk != current:
                for kind, tally in enumerate(tallies):
                    yield from cut(kind, current, tally)
                tallies = (Tally(), Tally())
            current = chunk
            block = Block([r["text"] for r in rows])
            learns = np.array([r["learn"] for r in rows])
            taught = np.repeat(learns, block.sizes)
            for keys, ids in block.orders():
                used = np.bincount(ids, minlength=len(keys)) > 0
                counts = np.bincount(ids[taught], minlength=len(keys))
                tallies[CONTEXTS].add(keys[used], counts[used])
            words, owners = block.words(hasher)
            number, found = pd.factorize(words)
            tallies[WORDS].add(found.astype(np.uint64), np.bincount(number[learns[owners]], minlength=len(found)))
            tallies[WORDS].add(np.array([END_KEY]), np.array([int(learns.sum())]))
        if current is not None:
            for kind, tally in enumerate(tallies):
                yield from cut(kind, current, tally)
        give_back()

    return run


def _arrays(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["counts"], np.int64)


def _streamed(batches) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):  # rows are large
            yield batch.slice(at, 1).to_pylist()[0]


def _tables(batches):
    """Sums of a bucket, in pieces of ascending keys."""
    current, tally = None, Tally()

    def pieces() -> Iterator[pa.RecordBatch]:
        keys, counts = tally.whole()
        for at in range(0, len(keys), TABLE_KEYS):
            yield pa.RecordBatch.from_pylist([{
                "kind": current[0], "bucket": current[1], "chunk": -len(keys) + at - 1, "keys": keys[at:at + TABLE_KEYS].tobytes(),
                "counts": counts[at:at + TABLE_KEYS].tobytes()}], schema=_ARROW_COUNTS)

    for row in _streamed(batches):
        if current != (row["kind"], row["bucket"]):
            if current:
                yield from pieces()
            current, tally = (row["kind"], row["bucket"]), Tally()
        tally.add(*_arrays(row))
    if current:
        yield from pieces()


_ARROW_ANSWERS = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("keys", pa.binary()), ("answers", pa.binary())])


def _answers(batches):
    """Per bucket, pieces of its table come first; then each chunk's keys are looked up in it."""
    current, pieces, table = None, [], None
    for row in _streamed(batches):
        if current != (row["kind"], row["bucket"]):
            current, pieces, table = (row["kind"], row["bucket"]), [], None
        if row["chunk"] < 0:
            pieces.append(_arrays(row))
            continue
        if table is None:
            keys, counts = (np.concatenate(part) for part in zip(*pieces))
            table, pieces = (keys, node_odds(keys, counts) if row["kind"] == CONTEXTS else counts), []
        asked = _arrays(row)[0]
        yield pa.RecordBatch.from_pylist([{
            "chunk": row["chunk"], "kind": row["kind"], "keys": row["keys"],
            "answers": table[1][np.searchsorted(table[0], asked)].tobytes()}], schema=_ARROW_ANSWERS)


_SCORES = "key long, learn boolean, n_bytes long, n_tokens long, n_known long, base_score double, log2 double"
_ARROW_SCORES = pa.schema([
    ("key", pa.int64()), ("learn", pa.bool_()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("base_score", pa.float64()), ("log2", pa.float64())])


def _scored(tokens: int, distinct: int):
    def run(batches):
        current, parts, tables, hasher = None, ([], []), None, WordHasher()
        for chunk, rows in _blocks(batches):
            if chunk != current:
                current, parts, tables = chunk, ([], []), None
            if rows[0]["text"] is None:
                row = rows[0]
                values = np.frombuffer(row["answers"], np.int8).reshape(-1, WIDTH) if row["kind"] == CONTEXTS else np.frombuffer(row["answers"], np.int64)
                parts[row["kind"]].append((np.frombuffer(row["keys"], np.uint64), values))
                continue
            if tables is None:
                tables = []
                for part in parts:
                    keys = np.concatenate([k for k, _ in part])
                    order = np.argsort(keys)
                    tables.append((keys[order], np.concatenate([v for _, v in part])[order]))
                parts = ([], [])
            block = Block([r["text"] for r in rows])
            numbers, odds = [], []
            for keys, ids in block.orders():
                place = np.minimum(np.searchsorted(tables[CONTEXTS][0], keys), len(tables[CONTEXTS][0]) - 1)
                numbers.append(ids)  # pairs of the padding between texts have no entry and are not selected by ids
                odds.append(tables[CONTEXTS][1][place])
            log2 = text_bits(block.sizes, block.offsets, numbers, odds)
            words, owners = block.words(hasher)
            number, found = pd.factorize(words)
            counts = tables[WORDS][1][np.searchsorted(tables[WORDS][0], found.astype(np.uint64))][number]
            end = int(tables[WORDS][1][np.searchsorted(tables[WORDS][0], END_KEY)])
            chance = lambda c: np.log10((c + 0.1) / (tokens + 0.1 * (distinct + 1)))
            count = np.bincount(owners, minlength=len(rows))
            known = np.bincount(owners[counts > 0], minlength=len(rows))
            base = row_sums(owners, chance(counts), len(rows)) + chance(end)
            yield pa.RecordBatch.from_arrays([
                pa.array([r["key"] for r in rows], pa.int64()), pa.array([r["learn"] for r in rows], pa.bool_()),
                pa.array(block.sizes - 1), pa.array(count + 1), pa.array(known + (end > 0)), pa.array(base), pa.array(log2)],
                schema=_ARROW_SCORES)
        give_back()

    return run


def score_texts(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of all texts, learning from the rows where ``learn`` holds (null does not).

    Returns key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 of the model's probability of the
    text) and bits_per_byte, the end mark included.
    """
    rows = stored(docs.select(
        F.col(key).cast("long").alias("key"), F.coalesce(learn, F.lit(False)).alias("learn"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
        F.shiftright(F.monotonically_increasing_id(), 16).alias("chunk")), "texts")
    chunks = rows.select("chunk").distinct().count()
    buckets = 8 * max(1, round(chunks ** 0.5))
    asked = stored(rows.mapInArrow(_asked(buckets), _COUNTS), "asked")
    tables = stored(asked.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", "chunk").mapInArrow(_tables, _COUNTS), "tables")
    totals = (tables.filter(F.col("kind") == WORDS).mapInArrow(_totals, "tokens long, distinct long")
              .agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct")).first())
    answers = (tables.unionAll(asked).repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", "chunk")
               .mapInArrow(_answers, "chunk long, kind int, keys binary, answers binary"))
    nothing = lambda kind: F.lit(None).cast(kind)
    both = answers.select("chunk", "kind", "keys", "answers", nothing("long").alias("key"), nothing("boolean").alias("learn"),
                          nothing("binary").alias("text")).unionAll(
        rows.select("chunk", F.lit(9).alias("kind"), nothing("binary"), nothing("binary"), "key", "learn", "text"))
    scored = (both.repartition("chunk").sortWithinPartitions("chunk", "kind")
              .mapInArrow(_scored(totals["tokens"] or 0, totals["distinct"] or 0), _SCORES))
    return scored.select(
        F.col("key").alias(key), (~F.col("learn")).alias("held_out"), "n_tokens", "n_known",
        F.lit(totals["tokens"] or 0).cast("long").alias("train_tokens"), "base_score",
        (F.col("log2") * F.log10(F.lit(2.0))).alias("score"), (-F.col("log2") / (F.col("n_bytes") + 1)).alias("bits_per_byte"))


def _totals(batches):
    for row in _streamed(batches):
        counts = _arrays(row)[1]
        yield pa.RecordBatch.from_pylist([{"tokens": int(counts.sum()), "distinct": int((counts > 0).sum())}],
                                         schema=pa.schema([("tokens", pa.int64()), ("distinct", pa.int64())]))
