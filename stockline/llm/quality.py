"""Quality scores of documents: an additive model with pairwise interactions.

Every text is described by numbers of its form: letters, digits, signs, words,
lines, repetition. For each number the model has a lookup table over bins, and
for chosen pairs of numbers a table over a grid. The tables are learned by cyclic
boosting: round after round, each number in turn gets a shallow tree on the
residuals, whose leaves are added to its table; pairs follow on what is left. A
score is the logistic function of the sum of the table entries, looked up for a
whole batch at once, so it can be read off table by table.

Features are computed for every document and over whole texts. The model is
fitted on the driver on at most ``sample`` labelled documents (the least
hashes of their ids, so the choice repeats), a bound that does not grow.

Defined cases: null and empty texts have all features zero and get a score like
any other; several labels of one id count as their mean; without labels of both
kinds every score is the share of ones, a half if there is none; rows that share
an id are scored each, and one of them stands for the id in fitting.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stockline.llm.common import byte_class, small_batches, stored

FEATURES = (
    "log_bytes", "log_words", "upper", "digits", "signs", "odd_signs", "spaces", "high", "word_length", "long_words", "distinct_words",
    "top_word", "plain_words", "signed_ends", "upper_words", "log_lines", "line_length", "repeated_lines", "repeated_pairs", "packed")
_UPPER, _LOWER, _DIGIT = byte_class((65, 90)), byte_class((97, 122)), byte_class((48, 57))
_SPACE, _HIGH = byte_class((9, 13), (32, 32)), byte_class((128, 255))
_SIGN = ~(_UPPER | _LOWER | _DIGIT | _SPACE | _HIGH)
_USUAL = np.isin(np.arange(256), np.frombuffer(b".,;:'\"!?()-", np.uint8))
_CLASSES = np.stack([_UPPER, _DIGIT, _SIGN, _SIGN & ~_USUAL, _SPACE, _HIGH]).astype(np.int64)


def describe(text: bytes | None) -> list[float]:
    """The features of one text, in the order of ``FEATURES``."""
    if not text:
        return [0.0] * len(FEATURES)
    size = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = (_CLASSES @ counts / size).tolist()
    words, lines = text.split(), text.split(b"\n")
    n = max(len(words), 1)
    each = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    lengths = list(map(len, words))
    times = Counter(lines)
    twice = sum((k - 1) * len(line) for line, k in times.items() if k > 1)
    ends = Counter(w[-1:] for w in words)
    return [
        math.log1p(size), math.log1p(len(words)), *shares, sum(lengths) / n, sum(x > 24 for x in lengths) / n, len(each) / n,
        max(each.values(), default=0) / n, sum(map(bytes.isalpha, words)) / n,
        sum(k for e, k in ends.items() if e in b"#$%&*!|@^~+=<>\\/_" and e) / n, sum(map(bytes.isupper, words)) / n,
        math.log1p(len(lines)), math.log1p(size / len(lines)), twice / size, 1 - pairs / max(len(words) - 1, 1) if len(words) > 1 else 0.0,
        len(zlib.compress(text, 1)) / size]


@dataclass
class AdditiveModel:
    """Lookup tables of single features and of pairs of features."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, f], side="right")]
        for i, j, a, b, table in self.pairs:
            total += table[np.searchsorted(a, x[:, i], side="right"), np.searchsorted(b, x[:, j], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _split(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """The best cut of a run of bins: its gain, and the first bin of the right side."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    best = int(gain.argmax())
    return float(gain[best]), best + 1


def _leaves(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """The steps of a shallow tree over ordered bins."""
    runs, out = [(0, len(g))], np.zeros(len(g))
    while len(runs) < leaves:
        (gain, cut), (a, b) = max(((_split(g[a:b], h[a:b], ridge), (a, b)) for a, b in runs), key=lambda x: x[0][0])
        if gain <= 0:
            break
        runs.remove((a, b))
        runs += [(a, a + cut), (a + cut, b)]
    for a, b in runs:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def _grid_leaves(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """The steps of a tree that cuts one axis of a grid and then each side on the other axis."""
    best = (-1.0, np.zeros_like(g))
    for gg, hh, turned in ((g, h, False), (g.T, h.T, True)):
        for cut in range(1, gg.shape[0]):
            gain, out = 0.0, np.zeros_like(gg)
            for side in (slice(0, cut), slice(cut, None)):
                gs, hs = gg[side].sum(axis=0), hh[side].sum(axis=0)
                more, at = _split(gs, hs, ridge)
                gain += max(more, 0) + gs.sum() ** 2 / (hs.sum() + ridge)
                for part in (slice(0, at), slice(at, None)) if more > 0 else (slice(None),):
                    out[side, part] = gs[part].sum() / (hs[part].sum() + ridge)
            if gain > best[0]:
                best = (gain, out.T if turned else out)
    return best[1]


def fit_additive(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 200, rate: float = 0.1, leaves: int = 3, n_pairs: int = 8,
                 grid: int = 8, pair_rounds: int = 50, ridge: float = 2.0) -> AdditiveModel:
    """Fit the tables; of every seven rows one is set apart and decides how many rounds are kept."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    model = AdditiveModel(math.log(share / (1 - share)))
    if len(y) < 20 or y.min() == y.max():
        return model
    model.edges = [_edges(x[:, f], bins) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    at = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    apart = np.arange(len(y)) % 7 == 0
    train = ~apart
    total = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return np.where(train, y - p, 0), np.where(train, p * (1 - p), 0)

    def loss():
        return float(np.logaddexp(0, np.where(y[apart] > 0, -total[apart], total[apart])).mean())

    def boosted(count, turn, keep):
        best, since = loss(), 0
        kept = keep()
        for _ in range(count):
            turn()
            now = loss()
            if now < best - 1e-5:
                best, kept, since = now, keep(), 0
            elif (since := since + 1) >= 15:
                break
        return kept

    def single_turn():
        nonlocal total
        for f, table in enumerate(model.tables):
            g, h = slopes()
            step = rate * _leaves(np.bincount(at[f], g, len(table)), np.bincount(at[f], h, len(table)), leaves, ridge)
            table += step
            total = total + step[at[f]]

    model.tables = boosted(rounds, single_turn, lambda: [t.copy() for t in model.tables])
    total = model.intercept + sum(t[at[f]] for f, t in enumerate(model.tables))

    # Pairs in order of what one tree on their grid would gain now.
    coarse = [_edges(x[:, f], grid) for f in range(x.shape[1])]
    where = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(coarse)]
    g, h = slopes()

    def on_grid(i, j, v):
        return np.bincount(where[i] * (len(coarse[j]) + 1) + where[j], v, (len(coarse[i]) + 1) * (len(coarse[j]) + 1)).reshape(len(coarse[i]) + 1, -1)

    gains = []
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            step = _grid_leaves(on_grid(i, j, g), on_grid(i, j, h), ridge)[where[i], where[j]]
            gains.append((float((g * step).sum()), i, j))
    chosen = [(i, j) for _, i, j in sorted(gains, reverse=True)[:n_pairs]]
    grids = [np.zeros((len(coarse[i]) + 1, len(coarse[j]) + 1)) for i, j in chosen]

    def pair_turn():
        nonlocal total
        for (i, j), table in zip(chosen, grids, strict=True):
            g, h = slopes()
            step = rate * _grid_leaves(on_grid(i, j, g), on_grid(i, j, h), ridge)
            table += step
            total = total + step[where[i], where[j]]

    grids = boosted(pair_rounds, pair_turn, lambda: [t.copy() for t in grids])
    model.pairs = [(i, j, coarse[i], coarse[j], t) for (i, j), t in zip(chosen, grids, strict=True)]
    return model


def with_features(documents: DataFrame, text_col: str = "text") -> DataFrame:
    """``documents`` with ``features`` in place of the text."""
    others = [c for c in documents.columns if c != text_col]
    own = documents.select(*others, F.col(text_col).cast("binary").alias(text_col))

    def run(batches):
        for batch in small_batches(batches, 16 << 20):
            rows = [describe(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array([np.array(r).tobytes() for r in rows], pa.binary())],
                                             names=[*batch.schema.names[:-1], "features"])

    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own.schema.fields[:-1])
    return own.mapInArrow(run, f"{kept}features binary")


def chosen_labels(labels: DataFrame, sample: int) -> DataFrame:
    """``(doc_id, quality)`` of at most ``sample`` labelled ids."""
    return (labels.groupBy("doc_id").agg(F.avg("quality").alias("quality")).filter("quality is not null and doc_id is not null")
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))


def fit_quality(features: DataFrame, chosen: DataFrame) -> AdditiveModel:
    """The model fitted on the rows of ``features`` (doc_id, features) that ``chosen`` names."""
    rows = (features.join(chosen, "doc_id").groupBy("doc_id").agg(F.min("features").alias("features"), F.first("quality").alias("quality"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").collect())
    x = np.array([np.frombuffer(r["features"]) for r in rows]).reshape(len(rows), len(FEATURES))
    return fit_additive(x, np.array([float(r["quality"] >= 0.5) for r in rows]))


def good_documents(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                   sample: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """The rows of ``documents``, with all their columns, that score at least ``threshold``.

    The labelled sample is described first; all rows are then described and
    scored where they are, so no text is shuffled.
    """
    chosen = stored(chosen_labels(labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("quality")), sample), "chosen")
    own = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # At most ``sample`` rows, so every task can hold them.
    model = fit_quality(with_features(own.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")), chosen)
    plain = documents.toDF(*[f"c{i}" for i in range(len(documents.columns))])
    at = documents.columns.index(text_col)

    def run(batches):
        for batch in small_batches(batches, 16 << 20):
            rows = [describe(x.encode() if x else b"") for x in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(model.score(np.array(rows).reshape(len(rows), len(FEATURES))) >= threshold))

    return plain.mapInArrow(run, plain.schema).toDF(*documents.columns)


def score_quality(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  sample: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """``(doc_id, score, predicted)`` of every row.

    ``labels``: ``doc_id`` and ``label_col``, the rows to learn from. Documents
    that have none are scored alike.
    """
    own = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    features = stored(with_features(own), "features")
    model = fit_quality(features, chosen_labels(labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).alias("quality")), sample))

    def run(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(1).to_pylist())).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    return features.select("doc_id", "features").mapInArrow(run, "doc_id long, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
