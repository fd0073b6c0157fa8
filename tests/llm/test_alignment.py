"""Token groups of two tokenizers against the libraries themselves and a merge of their ends."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stallwise.llm import alignment, bpe

RANKS, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = Tokenizer.from_file(RANKS), sentencepiece.SentencePieceProcessor(model_file=PIECES)
A.encode_special_tokens = True
SIGNS = {shown: byte for byte, shown in enumerate(alignment.byte_signs())}


def tokens(text):
    """(ids, bytes) of both sides by the libraries, whole texts at once; None where the bytes differ from the text."""
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    a_bytes = [bytes(SIGNS[c] for c in A.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode() for i in b]
    same = text and b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode()
    return ((a, a_bytes), (b, b_bytes)) if same else None


def grouped(text):
    """The groups as pairs of id lists, found by walking both token lists side by side."""
    found = tokens(text or "")
    if not found:
        return []
    out, sides = [], [iter(zip(*x)) for x in found]
    reach, held = [0, 0], ([], [])
    whole = sum(map(len, found[0][1]))
    while reach[0] < whole or reach[1] < whole or held[0]:
        if held[0] and reach[0] == reach[1]:
            out.append(held)
            held = ([], [])
            continue
        side = int(reach[1] < reach[0])
        i, own = next(sides[side])
        held[side].append(i)
        reach[side] += len(own)
    return out


def expected(rows):
    groups = [(i, grouped(text)) for i, text in rows]
    counts = Counter((a[-1], b[-1]) for _, own in groups for a, b in own)
    best = {b: max(n for (_, other), n in counts.items() if other == b) for b in {b for _, b in counts}}
    for i, own in groups:
        links = [(a[-1], b[-1]) for a, b in own]
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        yield (
            i, sum(len(a) for a, _ in own), sum(len(b) for _, b in own), len(own), len(links),
            sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), hashlib.sha256(shown.encode()).hexdigest() if own else "",
        )


def test_digests(odd, table):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    rows += [(20, "a <|endoftext|> b"), (21, "▁low"), (22, "naïve façade, Straße — ﬁn\u0000\n\n\t x  y   z"), (23, "  blanks  "), (24, " ")]
    rows += [(25, "don't we'll 1234567 " * 9000 + " "), (26, "今日は良い天気ですね" * 300)]
    found = alignment.digests(table(rows), RANKS, PIECES, public_tokenizers.PATTERN).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted(map(tuple, found), key=key) == sorted(expected(rows), key=key)


def test_digests_of_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = alignment.digests(docs, RANKS, PIECES, public_tokenizers.PATTERN).collect()
    assert sorted(map(tuple, found)) == sorted(expected([(r.doc_id, r.text) for r in docs.collect()]))


def test_empty_table_and_clashing_columns(table):
    assert alignment.digests(table([]), RANKS, PIECES, public_tokenizers.PATTERN).count() == 0
    docs = table([(1, "some text"), (2, None)]).withColumn("Pairs", F.lit("old")).withColumn("n_a", F.lit("old")).withColumn("_text", F.lit("kept"))
    rows = {r.doc_id: r for r in alignment.groups(docs, RANKS, PIECES, public_tokenizers.PATTERN).collect()}
    (a, b), *rest = grouped("some text")
    assert rows[1].groups.startswith(",".join(map(str, a)) + "|" + ",".join(map(str, b))) and rows[1]._text == "kept" and rows[1].text == "some text"
    assert (rows[2].n_a, rows[2].groups, rows[2].pairs) == (0, "", [])


def test_terminals_of_a_long_chain():
    # A ends at even offsets, B at odd ones: one component of all tokens.
    n = 10_000
    a, b = np.append(np.arange(2, 2 * n, 2), 2 * n + 1), np.arange(1, 2 * n + 2, 2)
    ends = alignment.terminals(a, b)
    assert all((x == len(b) - 1).all() for x in ends)


def test_very_long_blanks_take_the_ids_of_one_match():
    encoder = bpe.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    for n in (4096, 5000, 20_000):
        for text in (" " * n, "a" + " " * n + "b", "a\n" + "\t " * n + "\n", " " * n + "x" + " " * n, "x " + " " * n + ", y"):
            assert bpe.ids_of(encoder, text).tolist() == encoder.encode_ordinary(text)
    assert bpe.bytes_of(encoder, bpe.ids_of(encoder, " " * 2_000_000 + "end").tobytes()) == b" " * 2_000_000 + b"end"
