"""The pipeline's stages on a small corpus with planted cases, and all registered queries over the smallest table."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from stallwise.llm import queries

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")
OPERATORS = [
    "op1_class_bigrams", "op2_license_windows", "op3_pairwise_quality", "op4_edit_decontamination", "op5_nearest_toxicity", "op6_bootstrapped_pii",
    "op7_pruned_graph_neighbours", "op8_byte_bpe", "op9_differencing_shards", "op10_ngram_jaccard",
    "op11_tag_path_text", "op12_block_hash_trie", "op13_token_alignment",
]


def test_registered():
    assert set(OPERATORS) == set(queries.QUERIES) and set(OPERATORS) | {"pipeline"} <= set(entry.queries())


def corpus(spark, folder):
    good = lambda i: f"In the year {i * 37} the town of place{i} had a fair that day{i} brought guest{i * 3} and trade{i * 7} to the square by name{i * 11} and road{i * 13} at noon"
    item = "which of the following rivers runs through the largest number of capital cities on its way to the sea"
    rows = [(i, good(i)) for i in range(40)]
    rows += [(100, good(5)), (101, good(6) + " end"), (102, good(50) + " " + item + " " + good(51)), (103, "$$$ ### !!! | | ### $$$ %%% " * 9)]
    rows += [(104, good(60) + " mail me at a.b@c.de"), (105, good(61)), (105, good(61)), (None, good(62)), (106, None), (107, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    bad = [(200 + i, "### $$$ %%% | | !!! ") for i in range(10)]
    labels = [(i, 1, 0) for i in range(40)] + [(103, 0, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return dict(rows[:-2]), bad


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    texts, _ = corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        seen[name] = sorted((r.doc_id for r in docs.select("doc_id").collect()), key=str)
        if name != "tokenize":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert 103 not in seen["quality"] and set(range(40)) <= set(seen["quality"])
    assert {100, 101} & set(seen["near_duplicates"]) == set() and seen["near_duplicates"].count(105) == 1 and None in seen["near_duplicates"]
    assert 102 in seen["near_duplicates"] and 102 not in seen["decontaminate"] and set(range(40)) <= set(seen["decontaminate"])
    redacted = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/redact").collect()}
    assert redacted[104].endswith("mail me at [EMAIL]") and redacted[7] == texts[7]
    assert all(r.exact and r.n_tokens * 4 == len(r.ids) for r in docs.collect())
    whole = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, whole.collect())) == sorted(map(str, docs.collect()))


@needs_tables
@pytest.mark.parametrize("name", OPERATORS)
def test_query_covers_its_table(spark, name):
    rows = queries.QUERIES[name](spark, SF_DIR)
    whole = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    if name.startswith(("op2_", "op4_")):
        assert "doc_id" in rows.columns and rows.count() >= 0
    elif name.startswith("op7_"):
        ids = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").where("vec_id % 50 = 0").count()
        assert rows.count() == 5 * ids
    elif name.startswith("op11_"):
        assert rows.count() == spark.read.parquet(f"{SF_DIR}/pages.parquet").count()
    elif name.startswith("op12_"):
        conversations = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id").distinct().count()
        assert rows.where("depth = 0").first().n_convs == conversations
    else:
        assert rows.count() == whole


def test_rows_are_told_apart_by_id_and_text(spark):
    words = lambda a, n=30: " ".join(f"w{a}x{i}" for i in range(n))
    rows = [(5, words(1)), (5, words(2)), (7, words(1)), (None, words(3)), (None, words(3)), (None, words(4)), (9, words(4)), (11, None), (11, None), (12, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumn("_key", F.lit(1))
    found = corpus_pipeline.keep_distinct(spark, docs, "")
    assert found.columns == docs.columns
    want = [(5, words(1)), (5, words(2)), (None, words(3)), (9, words(4)), (11, None), (12, "")]
    assert sorted(((r.doc_id, r.text) for r in found.collect()), key=str) == sorted(want, key=str)


def test_stages_of_empty_documents(spark, tmp_path):
    folder = str(tmp_path)
    corpus(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{folder}/empty-{name}")
        docs = spark.read.parquet(f"{folder}/empty-{name}")
        assert docs.count() == 0
