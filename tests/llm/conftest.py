from __future__ import annotations

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark):
    """Documents from (doc_id, text) pairs, with the columns of the real table."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)

    return make


@pytest.fixture
def odd(table):
    """NULLs in any column, empty, blank and very long texts, repeated rows and ids."""
    return table([
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "word " * 60_000), (6, "same text of some words"), (6, "same text of some words"),
        (7, "same text of some words"), (8, "éà 😀 ß 中文 text"), (None, "a text without an id"), (None, None), (9, "x" * 200_000), (9, "another text of nine"),
    ])
