"""Benchmark passages in documents, found by winnowed fingerprints.

Texts are lower-cased (A-Z) and read as words of digits, letters and all that is
not ASCII. Of every ``window`` consecutive words the operator keeps the
``gram``-word hash that is smallest (the last of equal ones): with
``window - gram + 1`` grams to choose from, the choice depends on nothing but
those ``window`` words, so every span of ``window`` words that a document
shares with an item has a kept hash in common at the same place. Items shorter
than ``window`` are one span of their own length; for each such length that
occurs, documents are read with grams of that length as well.

The kept hashes of both sides are joined in Spark. Each carries its gram and
the words beside it, as far as a window can reach; a match counts only if the
grams are equal as text, and is extended word by word to both sides. Where the
extended span is a window long or longer, its words are hit.

Before the join, documents drop the hashes that no item can have, by a bitmap
of 2**23 bits (one megabyte whatever the size of either table); a full bitmap
only lets more hashes through.

Defined cases: null texts and texts without words have no words and no hits;
items without words never occur; items without an id mark words but are not
counted; rows that repeat an item or a document are judged each; a document's
``row_key`` (a hash of id and text) tells apart rows that share an id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from stockline.llm.common import ALNUM, WordHasher, gram_hashes, lower_bytes, stored, word_spans

BITS = 23
_PRINT = pa.struct([("hash", pa.int64()), ("pos", pa.int32()), ("size", pa.int32()), ("gram", pa.string()),
                    ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))])
_PRINTS = "array<struct<hash: bigint, pos: int, size: int, gram: string, left: array<string>, right: array<string>>>"


def winnow(hashes: np.ndarray, span: int) -> np.ndarray:
    """Positions of the smallest hash, the last of equal ones, in each run of ``span``."""
    if len(hashes) < span:
        return np.zeros(0, dtype=np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(hashes, span)[:, ::-1]
    return np.unique(np.arange(len(runs)) + (span - 1) - runs.argmin(axis=1))


class Fingerprints:
    """Fingerprints of one text after another."""

    def __init__(self, window: int, gram: int, lengths: list[int] | None, bitmap: np.ndarray | None) -> None:
        self.window, self.gram, self.lengths, self.bitmap, self.hasher = window, gram, lengths, bitmap, WordHasher()

    def __call__(self, text: bytes | None) -> tuple[int, list[dict]]:
        data = lower_bytes(text)
        starts, ends = word_spans(data, ALNUM)
        count = len(starts)
        if self.lengths is None:  # an item
            sizes = [self.gram] if count >= self.window else [count] * bool(count)
        else:
            sizes = list(dict.fromkeys([self.gram] * (count >= self.window) + [n for n in self.lengths if n <= count]))
        words, prints = self.hasher(data, starts, ends), []
        raw = None
        for size in sizes:
            hashes = gram_hashes(words, size)
            whole = size != self.gram or count < self.window or self.lengths is not None and size in self.lengths and size == self.gram
            at = np.arange(len(hashes)) if whole else winnow(hashes, self.window - size + 1)
            if self.bitmap is not None:
                slot = hashes[at] & np.uint64((1 << BITS) - 1)
                at = at[(self.bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)]
            reach = 0 if size != self.gram or count < self.window else self.window - size
            for i in at.tolist():
                raw = raw or data.tobytes()
                word = lambda j: raw[starts[j]:ends[j]].decode("utf-8", "replace")  # noqa: B023, E731
                prints.append({
                    "hash": int(hashes[i].astype(np.int64)), "pos": i, "size": size, "gram": " ".join(map(word, range(i, i + size))),
                    "left": [word(j) for j in range(i - 1, max(-1, i - 1 - reach), -1)],
                    "right": [word(j) for j in range(i + size, min(count, i + size + reach))]})
        return count, prints


def _with_prints(df: DataFrame, make) -> DataFrame:
    """``df`` (its last column the text as bytes) with ``n_words`` and ``prints`` in place of the text."""

    def run(batches):
        prints_of = make()
        for batch in batches:
            done = [prints_of(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([n for n, _ in done], pa.int64()), pa.array([p for _, p in done], pa.list_(_PRINT))],
                names=[*batch.schema.names[:-1], "n_words", "prints"])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields[:-1])
    return df.mapInArrow(run, f"{kept}, n_words bigint, prints {_PRINTS}")


def _shared(a: str, b: str, most: int) -> Column:
    """How many words two lists of neighbours share from their beginning."""
    total = F.lit(0)
    for i in range(most - 1, -1, -1):
        same = F.get(a, F.lit(i)) == F.get(b, F.lit(i))
        total = F.when(same, total + 1).otherwise(0)
    return total


def find_passages(documents: DataFrame, benchmark: DataFrame, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = 10, gram: int = 6) -> DataFrame:
    """``(doc_id, row_key, n_words, n_hit, item_ids)`` of every document row.

    ``item_ids``: the ids, as sorted strings, of items with a window in the document.
    """
    spark = documents.sparkSession
    items = stored(_with_prints(
        benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text_col).cast("binary").alias("text")),
        lambda: Fingerprints(window, gram, None, None)).select("item_id", F.explode("prints").alias("p")).select("item_id", "p.*"), "items")
    lengths = sorted(r[0] for r in items.filter(F.col("gram") != "").filter(
        (F.col("size") != gram) | (F.size("left") + F.size("right") == 0)).select("size").distinct().collect() if r[0] < window)
    slot = F.col("hash").bitwiseAND((1 << BITS) - 1)
    words = (items.select(slot.alias("s")).distinct().groupBy(F.shiftright("s", 6).alias("at"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(s & 63 as int)))").alias("bits")).collect())
    bitmap = np.zeros(1 << (BITS - 6), dtype=np.int64)
    bitmap[[r["at"] for r in words]] = [r["bits"] for r in words]
    shared = spark.sparkContext.broadcast(bitmap.view(np.uint64))

    # One row for each different fingerprint; which items it stands for is joined in at the end.
    context = F.md5(F.concat_ws("\n", F.col("size").cast("string"), "gram", F.concat_ws(" ", "left"), F.concat_ws(" ", "right")))
    items = items.withColumn("context", context)
    contexts = items.dropDuplicates(["context"]).select("context", "hash", "size", "gram", F.col("left").alias("i_left"), F.col("right").alias("i_right"))
    docs = documents.select(F.col(doc_col).alias("doc_id"), F.xxhash64(F.col(doc_col), F.col(text_col)).alias("row_key"), F.col(text_col).cast("binary").alias("text"))
    docs = stored(_with_prints(docs, lambda: Fingerprints(window, gram, lengths, shared.value)), "prints")

    found = docs.filter(F.size("prints") > 0).select("doc_id", "row_key", F.explode("prints").alias("p")).select("doc_id", "row_key", "p.*")
    left, right = _shared("left", "i_left", window - gram), _shared("right", "i_right", window - gram)
    pairs = found.join(contexts, ["hash", "size", "gram"]).select(
        "doc_id", "row_key", "context", "size", "pos", left.alias("l"), right.alias("r"),
        (F.size("i_left") + F.size("i_right") == 0).alias("short"))
    need = F.when(F.col("short"), F.col("size")).otherwise(window)
    hits = stored(pairs.filter(F.col("l") + F.col("size") + F.col("r") >= need).select(
        "doc_id", "row_key", "context", (F.col("pos") - F.col("l")).alias("a"), (F.col("pos") + F.col("size") + F.col("r")).alias("b")), "hits")
    merged = F.aggregate(
        F.sort_array("spans"), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(acc["end"], s["a"]))).cast("long").alias("n"),
                                F.greatest(acc["end"], s["b"]).alias("end")))
    covered = (hits.select("doc_id", "row_key", "a", "b").distinct().groupBy("doc_id", "row_key")
               .agg(F.collect_list(F.struct("a", "b")).alias("spans")).select("doc_id", "row_key", merged["n"].alias("n_hit")))
    named = (hits.select("doc_id", "row_key", "context").distinct()
             .join(items.select("context", "item_id").distinct(), "context").filter("item_id is not null")
             .select("doc_id", "row_key", "item_id").distinct().groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids")))

    def same_row(a: DataFrame, b: DataFrame) -> Column:
        return a["row_key"].eqNullSafe(b["row_key"]) & a["doc_id"].eqNullSafe(b["doc_id"])

    # The two small sides meet first, so the rows of all documents are joined once.
    hit = covered.join(named, same_row(covered, named), "left").select(
        covered["doc_id"].alias("h_doc"), covered["row_key"].alias("h_row"), "n_hit", "item_ids")
    return docs.join(hit, docs["row_key"].eqNullSafe(F.col("h_row")) & docs["doc_id"].eqNullSafe(F.col("h_doc")), "left").select(
        docs["doc_id"], docs["row_key"], docs["n_words"], F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
