"""Groups of tokens that two tokenizers make of one text, and how often each pair of ids ends together.

Both tokenizations cut the same bytes. Two tokens overlap when they share a byte; the groups are the components of that
relation. Every token points to the token that overlaps it and reaches farthest right; doubling the pointers (each
takes its successor's successor) brings all tokens of a component to its last one within log2(tokens) rounds. All texts
of a batch are doubled at once, as their ends never coincide with another text's tokens.

The corpus is read once: the groups' digests and the linked pairs of each text go to a written table, whose pairs are
added up and brought back to each text. Where two tokens end together, one's bytes end the other's. So there are at
most as many linked pairs as the two vocabularies have bytes (twice, for pieces that repeat a byte piece), whatever the
corpus holds: that bounds the table of pair counts that every task gets.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from stallwise.llm import bpe, words
from stallwise.sources import scratch

# About so many bytes of text are aligned at once.
CHUNK = 1 << 20
PAIR = np.int64(1 << 32)


class Tokenizers:
    """Two tokenizers with the bytes of every id: byte-level BPE from a JSON file (A), pieces from a model file (B)."""

    def __init__(self, ranks: str, pieces: str, pattern: str) -> None:
        import sentencepiece
        import tiktoken

        with open(ranks, encoding="utf-8") as file:
            model = json.load(file)
        vocabulary, special = model["model"]["vocab"], {x["content"] for x in model["added_tokens"]}
        sign = {shown: byte for byte, shown in enumerate(byte_signs())}
        table = {bytes(map(sign.__getitem__, token)): i for token, i in vocabulary.items() if token not in special}
        made = ("".join(merge.split(" ") if isinstance(merge, str) else merge) for merge in model["model"]["merges"])
        if any(vocabulary[token] != i for i, token in enumerate(made, 256)):
            raise ValueError("ids of merged tokens must stand in the order of the merges")
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a_bytes = [b""] * (1 + max(vocabulary.values()))
        for token, i in table.items():
            self.a_bytes[i] = token
        spelled = map(self.b.id_to_piece, range(self.b.get_piece_size()))
        self.b_bytes = [bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(spelled)]
        if any(b" " in x.lstrip(b" ") for x in self.b_bytes):
            raise ValueError("a piece goes on after a space, so long texts can't be cut before spaces")
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.blank = [self.b.piece_to_id("▁")]
        # An id with the sign that follows it: another of its side, the other side, the next group.
        self.spelled = [f"{i}{end}" for x in (self.a_bytes, self.b_bytes) for i in range(len(x)) for end in ",|;"]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """The ids of a space and the text; none where either side's bytes differ from it."""
        none = np.zeros(0, np.int64)
        if not text:
            return none, none
        whole = " " + text
        a = bpe.ids_of(self.a, whole).astype(np.int64)
        b: list[int] = []
        for part in bpe.pieces(whole):
            # The model itself puts a space before what it gets.
            b += self.b.encode(part[1:]) if len(part) > 1 else self.blank
        want = whole.encode()
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != want or b"".join(map(self.b_bytes.__getitem__, b)) != want:
            return none, none
        return a, np.array(b, np.int64)


def byte_signs() -> list[str]:
    """The sign that stands for each byte in a byte-level vocabulary: itself where it prints, else the next from 256."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in set(shown)]
    return [chr(x) if x in set(shown) else chr(256 + rest.index(x)) for x in range(256)]


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A and each B token, the B token that ends its component. Ends ascend and the last ones are equal."""
    n = len(a_ends)
    to_b, to_a = np.searchsorted(b_ends, a_ends), np.searchsorted(a_ends, b_ends)
    own = np.arange(n, n + len(b_ends))
    farther = a_ends[to_a] > b_ends if n else np.zeros(0, bool)
    after = np.concatenate([n + to_b, np.where(farther, to_a, own)])
    while True:
        twice = after[after]
        if np.array_equal(twice, after):
            return after[:n] - n, after[n:] - n
        after = twice


def _align(texts: list[str], both: Tokenizers, spelled: bool) -> list[tuple]:
    """Per text: numbers of A tokens, B tokens and groups, the groups (or their digest), linked pairs and their counts."""
    coded = [both.encode(text) for text in texts]
    a, b = (np.concatenate([x[side] for x in coded]) for side in (0, 1))
    a_sizes, b_sizes = (np.array([len(x[side]) for x in coded]) for side in (0, 1))
    a_end, b_groups = terminals(np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b]))
    last = np.flatnonzero(b_groups == np.arange(len(b)))
    # Groups by number; a group's tokens stand together, A before B.
    a_group, b_group = np.searchsorted(last, a_end), np.searchsorted(last, b_groups)
    a_before, b_before = np.cumsum(np.bincount(a_group, minlength=len(last))), np.cumsum(np.bincount(b_group, minlength=len(last)))
    a_last = a_before - 1
    signs = np.empty(len(a) + len(b), np.int64)
    a_more, b_more = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    a_more[a_last], b_more[last] = 1, 2
    signs[np.arange(len(a)) + np.where(a_group > 0, b_before[a_group - 1], 0)] = a * 3 + a_more
    signs[np.arange(len(b)) + a_before[b_group]] = (len(both.a_bytes) + b) * 3 + b_more
    pairs = a[a_last] * PAIR + b[last]
    a_at, b_at = np.concatenate([[0], np.cumsum(a_sizes)]), np.concatenate([[0], np.cumsum(b_sizes)])
    g_at = np.searchsorted(last, b_at)
    out = []
    for i in range(len(texts)):
        shown = "".join(map(both.spelled.__getitem__, signs[a_at[i] + b_at[i] : a_at[i + 1] + b_at[i + 1]].tolist()))[:-1]
        if not spelled and shown:
            shown = hashlib.sha256(shown.encode()).hexdigest()
        codes, counts = np.unique(pairs[g_at[i] : g_at[i + 1]], return_counts=True)
        out.append((int(a_sizes[i]), int(b_sizes[i]), int(g_at[i + 1] - g_at[i]), shown, codes, counts))
    return out


def groups(
    docs: DataFrame, ranks: str, pieces: str, pattern: str, text: str = "text", spelled: bool = True, keep: list[str] | None = None
) -> DataFrame:
    """Add n_a, n_b, n_groups, groups, pairs and pair_counts to each row's `keep` columns (all, if None).

    Columns that have these names already are replaced.

    `groups` spells the groups (`a1,a2|b1;a3|b2,b3`), or holds the SHA-256 of that where `spelled` is false; `pairs` are
    the distinct linked pairs as a * 2^32 + b. A NULL or empty text, or one that a tokenizer changes, has no tokens:
    zeros, '' and no pairs. Repeated rows stay; an empty table gives no rows. `ranks` and `pieces` are paths that every
    executor can open.
    """
    added = dict.fromkeys(["n_a", "n_b", "n_groups"], LongType()) | {"groups": StringType()}
    added |= dict.fromkeys(["pairs", "pair_counts"], ArrayType(LongType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = Tokenizers(ranks, pieces, pattern)
        for batch in batches:
            texts = [x or "" for x in batch.column(batch.num_columns - 1).to_pylist()]
            start = size = 0
            for i, own in enumerate(texts, 1):
                size += len(own)
                if size >= CHUNK or i == len(texts):
                    yield part(batch.slice(start, i - start), texts[start:i], both)
                    start, size = i, 0

    def part(rows: pa.RecordBatch, texts: list[str], both: Tokenizers) -> pa.RecordBatch:
        n_a, n_b, n_groups, shown, codes, counts = zip(*_align(texts, both, spelled))
        ends = np.concatenate([[0], np.cumsum(list(map(len, codes)))]).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(x).astype(np.int64))) for x in (codes, counts)]
        new = [*(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)), pa.array(shown, pa.string()), *lists]
        return pa.RecordBatch.from_arrays([*rows.columns[:-1], *new], [*rows.schema.names[:-1], *added])

    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in added]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema
    for name, kind in added.items():
        schema = schema.add(name, kind)
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(words.free(docs, "_text")))
    return rows.mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The linked pairs of all rows, ascending, and how many links hold each. Their number is bounded by the vocabularies."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            codes, counts = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
            held, place = np.unique(np.concatenate([held, codes]), return_inverse=True)
            # Whole numbers below 2^53 stay exact.
            sums = np.bincount(place, np.concatenate([sums, counts]), len(held)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(sums)], ["pair", "n"])

    sums = aligned.select("pairs", "pair_counts").mapInArrow(add, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    found = sums.toArrow()
    codes, counts = (found.column(c).to_numpy() for c in ("pair", "n"))
    order = np.argsort(codes)
    return codes[order], counts[order]


def link_counts(aligned: DataFrame) -> DataFrame:
    """Add n_links, n_best and count_sum to rows of `groups`, whose pairs go (columns of these names are replaced).

    A pair's count is the number of links of all rows that hold it. n_best counts the links whose pair has the highest
    count of its B id, ties included; count_sum adds up the counts of all links. `aligned` is read twice: give it from a
    written table.
    """
    codes, counts = pair_counts(aligned)
    best = np.zeros(1 + int(np.max(codes % PAIR, initial=0)), np.int64)
    np.maximum.at(best, codes % PAIR, counts)
    table = aligned.sparkSession.sparkContext.broadcast((codes, counts, counts == best[codes % PAIR]))
    added = ["n_links", "n_best", "count_sum"]

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, top = table.value
        for batch in batches:
            own, many = batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1).flatten().to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(own.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            at = np.searchsorted(codes, own.flatten().to_numpy(zero_copy_only=False))
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (many, many * top[at], many * counts[at])] if len(codes) else [np.zeros(1 + ends[-1], np.int64)] * 3
            new = [pa.array(x[ends[1:]] - x[ends[:-1]], pa.int64()) for x in sums]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *new], [*batch.schema.names[:-2], *added])

    kept = [c for c in aligned.columns if c.lower() not in (*added, "pairs", "pair_counts")]
    schema = aligned.select(*[F.col(f"`{c}`") for c in kept]).schema
    for name in added:
        schema = schema.add(name, LongType())
    return aligned.select(*[F.col(f"`{c}`") for c in kept], "pairs", "pair_counts").mapInArrow(look, schema)


def digests(docs: DataFrame, ranks: str, pieces: str, pattern: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of each row of (doc_id, text)."""
    spark = docs.sparkSession
    folder = scratch.new_folder(spark, "aligned")
    groups(docs, ranks, pieces, pattern, spelled=False, keep=["doc_id"]).write.parquet(folder)
    linked = link_counts(spark.read.parquet(folder))
    return linked.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
