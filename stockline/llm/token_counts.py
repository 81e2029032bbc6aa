"""Token counts of documents without token ids.

A byte-level BPE never merges across pre-tokens, so a document's count is the
sum over its pre-tokens. Each task cuts its documents into chunks and turns a
chunk into one row per distinct pre-token: the pre-token, and for each document
of the chunk that has it, how often. These rows are partitioned and sorted by
pre-token, so all rows of a pre-token meet, its pieces are counted once, and
the counts are multiplied into the frequencies. What leaves a task are sums
per document, which a last grouping by chunk adds up.

A pre-token that makes up a third of all words still has only one row per
chunk, so no partition is hot; no id is materialised for any document.

Defined cases: null and empty texts have no bytes and no tokens; a special
string inside a text is the special token, as the library has it by default;
rows that share an id are counted each; texts are never cut.
"""

from __future__ import annotations

import functools
import json
import os
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from stockline.llm.common import small_batches

#: Documents of a chunk, and times of a word in one entry: both fit 16 bits.
CHUNK_DOCS, ENTRY = 4096, 15
CHUNK_BYTES = 12 << 20
# Fixed value: the pattern of byte-level pre-tokenisation.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
#: Begins the key of a chunk's list of documents; no pre-token mixes a control character with letters.
HEAD = "\x00chunk"
_ROWS = pa.schema([("piece", pa.string()), ("chunk", pa.int64()), ("uses", pa.binary())])
_SUMS = pa.schema([("chunk", pa.int64()), ("docs", pa.binary()), ("sums", pa.binary())])
_DOCS = np.dtype([("id", "<i8"), ("has_id", "?"), ("size", "<i8")])


class PreTokens:
    """Frequencies of pre-tokens and special tokens of a text."""

    def __init__(self, vocabulary: str) -> None:
        import regex

        with open(vocabulary, encoding="utf-8") as file:
            spec = json.load(file)
        steps = spec["pre_tokenizer"]
        if spec["normalizer"] or steps["type"] != "ByteLevel" or steps["add_prefix_space"] or not steps["use_regex"]:
            raise ValueError("pre-tokens are implemented for plain byte-level vocabularies")
        if any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("added tokens with options are not implemented")
        special = [t["content"] for t in spec["added_tokens"]]
        self.special = frozenset(special)
        self.split = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.find = regex.compile(PATTERN).findall

    def __call__(self, text: str) -> Counter:
        if self.split is None or not any(s in text for s in self.special):
            return Counter(self.find(text))
        total = Counter(self.split.findall(text))
        for part in self.split.split(text):
            total.update(self.find(part))
        return total


@functools.cache
def _tokenizer(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(vocabulary)
    found.no_truncation()
    found.no_padding()
    return found


class _Chunk:
    """Documents of one task, inverted: pre-token to (document, times)."""

    def __init__(self) -> None:
        self.ids, self.sizes, self.names = [], [], {}
        self.words, self.entries = [], []
        self.bytes = 0

    def add(self, doc_id: int | None, size: int, counts: Counter) -> None:
        names, doc = self.names, len(self.ids)
        self.ids.append(doc_id)
        self.sizes.append(size)
        self.bytes += size
        words = np.fromiter((names.setdefault(w, len(names)) for w in counts), np.int32, len(counts))
        times = np.fromiter(counts.values(), np.int64, len(counts))
        if len(times) and times.max() > ENTRY:  # a larger count is written as several entries
            parts = -(-times // ENTRY)
            words, full = np.repeat(words, parts), np.repeat(times, parts)
            nth = np.arange(len(full)) - np.repeat(np.cumsum(parts) - parts, parts)
            times = np.minimum(ENTRY, full - nth * ENTRY)
        self.words.append(words)
        self.entries.append((doc << 4 | times).astype(np.uint16))

    def rows(self, chunk: int) -> pa.RecordBatch:
        words, entries = np.concatenate(self.words), np.concatenate(self.entries)
        order = np.argsort(words, kind="stable")
        ends = np.cumsum(np.bincount(words, minlength=len(self.names))) * 2
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        uses = pa.Array.from_buffers(pa.binary(), len(self.names), [None, pa.py_buffer(offsets), pa.py_buffer(entries[order])])
        n = len(self.names)
        body = pa.RecordBatch.from_arrays([pa.array(self.names.keys(), pa.string()), pa.array(np.full(n, chunk)), uses], schema=_ROWS)
        docs = np.array([(i or 0, i is not None, size) for i, size in zip(self.ids, self.sizes, strict=True)], _DOCS)
        head = pa.RecordBatch.from_pylist([{"piece": f"{HEAD}{chunk}", "chunk": chunk, "uses": docs.tobytes()}], _ROWS)
        return pa.Table.from_batches([head, body]).combine_chunks()


def count_tokens(documents: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every row, by the byte-level vocabulary in file ``vocabulary``."""

    def invert(batches):
        pre, held, number = PreTokens(vocabulary), _Chunk(), TaskContext.get().partitionId() << 32
        for batch in small_batches(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.add(doc_id, len((text or "").encode()), pre(text or ""))
                if len(held.ids) == CHUNK_DOCS or held.bytes >= CHUNK_BYTES:
                    yield from held.rows(number).to_batches(max_chunksize=20_000)
                    held, number = _Chunk(), number + 1
        if held.ids:
            yield from held.rows(number).to_batches(max_chunksize=20_000)

    def multiply(batches):
        tokenizer, sums, last, last_count = _tokenizer(vocabulary), {}, None, 0

        def flush():
            if sums:
                docs = [np.flatnonzero(x) for x in sums.values()]
                yield pa.RecordBatch.from_pylist(
                    [{"chunk": c, "docs": d.astype(np.uint16).tobytes(), "sums": sums[c][d].tobytes()} for c, d in zip(sums, docs, strict=True)], _SUMS)
                sums.clear()

        for batch in batches:
            head = pc.starts_with(batch.column("piece"), HEAD)
            if pc.any(head).as_py():
                docs = batch.filter(head)
                yield pa.RecordBatch.from_arrays([docs.column("chunk"), docs.column("uses"), pa.nulls(docs.num_rows, pa.binary())], schema=_SUMS)
                batch = batch.filter(pc.invert(head))
            pieces, chunks = batch.column("piece").to_pylist(), batch.column("chunk").to_numpy()
            fresh = [i for i in range(len(pieces)) if pieces[i] != (pieces[i - 1] if i else last)]
            counts = np.zeros(len(pieces), np.int64)
            for i, found in zip(fresh, tokenizer.encode_batch([pieces[i] for i in fresh], add_special_tokens=False), strict=True):
                counts[i] = len(found)
            begin = np.zeros(len(pieces), np.int64)
            begin[fresh] = fresh
            begin = np.maximum.accumulate(begin)
            counts = counts[begin]
            if pieces and (not fresh or fresh[0] > 0):  # the batch goes on with the piece that the one before ended with
                counts[:fresh[0] if fresh else len(pieces)] = last_count
            if pieces:
                last, last_count = pieces[-1], counts[-1]
            sizes = pc.binary_length(batch.column("uses")).to_numpy() // 2
            entries = np.frombuffer(b"".join(batch.column("uses").to_pylist()), np.uint16)
            tokens = np.repeat(counts, sizes) * (entries & ENTRY)
            of, docs = np.repeat(chunks, sizes), entries >> 4
            for chunk in np.unique(of):
                here = of == chunk
                added = np.bincount(docs[here], tokens[here], CHUNK_DOCS).astype(np.int64)
                sums[chunk] = sums[chunk] + added if chunk in sums else added
            if len(sums) > 512:
                yield from flush()
        yield from flush()

    def add_up(table: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK_DOCS, np.int64)
        docs = np.zeros(0, _DOCS)
        for row in table.to_pylist():
            if row["sums"] is None:
                docs = np.frombuffer(row["docs"], _DOCS)
            else:
                total[np.frombuffer(row["docs"], np.uint16)] += np.frombuffer(row["sums"], np.int64)
        return pa.table({"doc_id": pa.array(docs["id"].copy(), mask=~docs["has_id"]), "n_bytes": pa.array(docs["size"].copy()), "n_tokens": total[:len(docs)]})

    rows = documents.select(F.col(id_col).cast("long"), F.col(text_col).alias("text")).mapInArrow(
        invert, "piece string, chunk long, uses binary")
    # Sorted by a hash: equal pieces are neighbours, and 64-bit keys sort many times faster than strings. Where two pieces share
    # a hash they may alternate, and are counted again.
    together = rows.repartition("piece").withColumn("h", F.xxhash64("piece")).sortWithinPartitions("h").drop("h")
    sums = together.mapInArrow(
        multiply, "chunk long, docs binary, sums binary")
    return sums.groupBy("chunk").applyInArrow(add_up, "doc_id long, n_bytes long, n_tokens long")
