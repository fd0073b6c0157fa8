"""Byte-level BPE encoding and decoding with a local rank file.

Each task builds one encoder from the rank file and works text by text. A long text is cut where no match of the
splitting pattern can reach across: before a space that follows a letter, digit or underscore. Every match begins with
at most one space and holds no other, and only runs of white space look ahead, so the pieces give the ids of the whole.
A very long run of white space is one match of the pattern (but for its last sign, where anything follows) and goes past
the pattern's matcher, whose stack such a run would overflow. Decoding joins the bytes of the ids and never repairs them, so it is exact even where an id ends inside a character.
"""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.llm import words

# About this many characters of a long text are encoded at once.
PIECE = 1 << 16
SAFE = re.compile(r"(?<=\w) ")
# The signs with Unicode's White_Space property, which are the pattern's white space.
BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{4096,}")


def load(path: str, pattern: str):
    """The tiktoken encoder of a rank file."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """Cut at the first safe place after each `size` characters."""
    start = 0
    while len(text) - start > size:
        found = SAFE.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def matches(encoder, part: str) -> Iterator[list[int]]:
    """The ids of a piece, long runs of white space apart from what stands around them."""
    start = 0
    for run in BLANKS.finditer(part) if len(part) >= 4096 else ():
        end = run.end() - (run.end() < len(part))
        yield encoder.encode_ordinary(part[start : run.start()])
        yield encoder._encode_single_piece(part[run.start() : end])
        start = end
    yield encoder.encode_ordinary(part[start:])


def ids_of(encoder, text: str) -> np.ndarray:
    parts = [np.asarray(ids, dtype="<u4") for part in pieces(text) for ids in matches(encoder, part)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def bytes_of(encoder, packed: bytes) -> bytes:
    return encoder.decode_bytes(np.frombuffer(packed, "<u4").tolist())


def encode(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add `ids`: the token ids of `text` as packed little-endian unsigned 32-bit integers (4 bytes an id).

    A NULL text has no ids (an empty value, not NULL). Other columns are kept; one already called `ids` is replaced.
    `ranks` is a path that every executor can open.
    """

    @F.pandas_udf("binary")
    @words.tidy
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load(ranks, pattern)
        for batch in batches:
            yield pd.Series([ids_of(encoder, value or "").tobytes() for value in batch], dtype=object)

    return docs.withColumn(ids, run(F.col(f"`{text}`")))


def decode(tokens: DataFrame, ranks: str, pattern: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add `out`: the bytes that packed `ids` stand for. NULL ids give no bytes (an empty value)."""

    @F.pandas_udf("binary")
    @words.tidy
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load(ranks, pattern)
        for batch in batches:
            yield pd.Series([bytes_of(encoder, bytes(value or b"")) for value in batch], dtype=object)

    return tokens.withColumn(out, run(F.col(f"`{ids}`")))


def round_trip(docs: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add `ids` and the bytes they decode to, as `decode(encode(docs))` does, with one encoder and one worker a task."""

    @F.pandas_udf("ids binary, decoded binary")
    @words.tidy
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = load(ranks, pattern)
        for batch in batches:
            packed = [ids_of(encoder, value or "").tobytes() for value in batch]
            yield pd.DataFrame({"ids": packed, "decoded": [bytes_of(encoder, own) for own in packed]}, dtype=object)

    both = words.free(docs, "_both")
    found = docs.withColumn(both, run(F.col(f"`{text}`")))
    return found.withColumn(ids, F.col(f"{both}.ids")).withColumn(out, F.col(f"{both}.decoded")).drop(both)


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Per row of (doc_id, text): number of ids, SHA-256 of the packed ids, SHA-256 of the bytes decoded from them.

    Repeated rows stay repeated; NULL and empty texts have 0 ids; an empty table gives no rows.
    """
    rows = round_trip(docs.select("doc_id", "text"), ranks, pattern).drop("text")
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
