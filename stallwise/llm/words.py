"""Words and word shingles of whole texts as 64-bit hashes: the worker-side helpers that several operators share.

A word is a run without space, tab, line feed, vertical tab, form feed or carriage return; A-Z are lower-cased, nothing
else is. A NULL text is an empty one.
"""

from __future__ import annotations

import ctypes
import functools
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIX = np.uint64(0x9E3779B97F4A7C15)
FOLD = np.uint64(0xC2B2AE3D27D4EB4F)
HALF = np.uint64(32)


def texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text, one at a time."""
    for value in column.cast(pa.binary()):
        yield value.as_py() or b""


def give_back() -> None:
    """Return freed memory to the system: a worker lives on between tasks, next to those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(work: Callable) -> Callable:
    """A worker function over batches that gives memory back after each batch and at the end of the task."""

    @functools.wraps(work)
    def run(batches):
        try:
            for out in work(batches):
                yield out
                del out
                give_back()
        finally:
            give_back()

    return run


def chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[bytes]]:
    """The texts of the first column in lists of about `most` bytes, so that what a task holds doesn't depend on batches."""
    held, size = [], 0
    for batch in batches:
        for text in texts(batch.column(0)):
            held.append(text)
            size += len(text)
            if size >= most:
                yield held
                held, size = [], 0
        # Give the batch's memory back before the next one is read.
        del batch
        give_back()
    if held:
        yield held


def words(text: bytes) -> list[bytes]:
    return text.lower().split()


def hashes(parts: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))


def shingles(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every run of k words; a shorter text is one shingle, an empty one has none."""
    n = len(word_hashes)
    if n == 0:
        return word_hashes
    k = min(k, n)
    out = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        out ^= word_hashes[j : n - k + 1 + j]
        out *= MIX
        out ^= out >> HALF
    out *= FOLD
    out ^= out >> HALF
    return out


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """The sorted distinct shingles of a text."""
    return np.unique(shingles(hashes(words(text)), k))


def digest(values: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    return xxhash.xxh3_128_digest(values.tobytes())


def free(df: DataFrame, name: str) -> str:
    """`name`, or a longer one that no column of `df` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bucket_of_id(column: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo `modulus`; a NULL id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


# Workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
