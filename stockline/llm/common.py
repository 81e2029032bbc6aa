"""Helpers that several corpus operators share."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from stockline.session import fresh_folder

_UPPER_TO_LOWER = np.arange(256, dtype=np.uint8)
_UPPER_TO_LOWER[65:91] += 32


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    The copy cuts the lineage and survives lost executors; its size is known
    to the planner, so joins with it are planned by measured size.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def file_system(uri: str):
    """``(file system, path)`` for a folder or file that executors share."""
    from pyarrow import fs

    local = re.match(r"(?:file:)?(/.*)$", uri)
    if local:
        return fs.LocalFileSystem(), re.sub(r"^/+", "/", local[1])
    return fs.FileSystem.from_uri(uri)


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A lookup table that is True for the bytes in the closed ``ranges``."""
    table = np.zeros(256, dtype=bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Bytes of UTF-8 words of digits, small letters and all that is not ASCII.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
#: Bytes of UTF-8 words that end at ASCII white space.
NOT_SPACE = ~byte_class((0x20, 0x20), (0x09, 0x0D))


def lower_bytes(text: bytes | None) -> np.ndarray:
    """The UTF-8 bytes of a text with A-Z turned into a-z; null is empty."""
    return _UPPER_TO_LOWER[np.frombuffer(text or b"", dtype=np.uint8)]


def word_spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the maximal runs of bytes in class ``inside``."""
    flags = np.zeros(len(data) + 2, dtype=np.int8)
    flags[1:-1] = inside[data]
    turns = np.diff(flags)
    return np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; the same input always gives the same output."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHasher:
    """64-bit hashes of words of one text, all at once.

    A word's hash is a polynomial in its bytes, read from one running sum
    over the text; powers and their inverses modulo 2**64 are kept, but for
    very long texts.
    """

    _STEP = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self) -> None:
        self._bytes = mix(np.arange(1, 257, dtype=np.uint64) * self._STEP)
        self._inverse_step = np.uint64(pow(int(self._STEP), -1, 1 << 64))
        self._kept = self._powers(1 << 16)

    def _powers(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        steps = np.full(size, self._STEP, dtype=np.uint64)
        back = np.full(size, self._inverse_step, dtype=np.uint64)
        steps[0] = back[0] = 1
        return np.cumprod(steps), np.cumprod(back)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = self._kept if len(data) < len(self._kept[0]) else self._powers(len(data) + 1)
        if len(self._kept[0]) < len(up) <= 1 << 21:
            self._kept = up, down  # those of longer texts are not kept
        running = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self._bytes[data] * up[:len(data)], out=running[1:])
        return mix((running[ends] - running[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` consecutive words."""
    count = len(words) - k + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(count, k, dtype=np.uint64)
    for j in range(k):
        total = total * np.uint64(0xD6E8FEB86659FD93) + words[j:j + count]
    return mix(total)


def give_back() -> None:
    """Return freed memory to the system; a worker goes on to other tasks and may stay idle beside them."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it, others need no such call
    if trim:
        trim(0)


def small_batches(batches, most: int = 4 << 20):
    """Arrow batches cut to pieces of at most ``most`` bytes, or one row where that alone is longer."""
    for batch in batches:
        rows = max(1, batch.num_rows * most // max(batch.nbytes, most))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
    give_back()
