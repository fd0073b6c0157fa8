"""Quality, toxicity and the language model: held-out results, exact parts against brute force."""

from __future__ import annotations

import collections
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwise.llm import classmodel, quality, toxicity, words

GOOD = "The plan for the week was set and all of the work went on in the usual way."
POOR = "Buy!! $$$ now%%% ### cheap&&& | | | OFFER*** ### !!! $$$"


def labelled(spark, table, texts, label):
    docs = table([(i, t) for i, (t, _) in enumerate(texts)])
    marks = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(texts)] + [(None, 1), (10**6, 0), (3, None)], f"doc_id long, {label} int")
    return docs, marks


def test_quality_ranks_unseen_texts(spark, table, odd):
    rng = np.random.default_rng(1)
    texts = [(" ".join(rng.permutation((GOOD if y else POOR).split() * 4)), int(y)) for y in rng.random(150) < 0.8]
    docs, marks = labelled(spark, table, texts, "quality")
    ranking = quality.learn(docs, marks, "quality", words.bucket_of_id("doc_id", 5) != 0)
    rows = docs.withColumn("score", quality.score(F.col("text"), ranking)).collect()
    assert all((r.score >= quality.CUT) == (texts[r.doc_id][1] == 1) for r in rows)
    scores = [r[0] for r in odd.select(quality.score(F.col("text"), ranking)).collect()]
    assert len(scores) == odd.count() and all(0 <= s <= 1 for s in scores)


def test_quality_without_pairs(spark, table):
    docs = table([(1, GOOD), (2, "")])
    for marks, passes in (([], True), ([(1, 1)], True), ([(1, 0)], False)):
        ranking = quality.learn(docs, spark.createDataFrame(marks, "doc_id long, quality int"), "quality", F.lit(True))
        scores = [r[0] for r in docs.select(quality.score(F.col("text"), ranking)).collect()]
        assert all((s >= quality.CUT) == passes for s in scores)


def test_quality_learns_from_all_labels(spark):
    n, poor = 24_000, 3_000
    ids = spark.range(n).withColumnRenamed("id", "doc_id")
    noise = [F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(most)).cast("int") for i, most in enumerate((97, 1009))]
    docs = ids.withColumn("text", F.concat(F.sha2(F.col("doc_id").cast("string"), 256), F.repeat(F.lit(" ab!"), noise[0]), F.repeat(F.lit("z"), noise[1])))
    marks = ids.withColumn("quality", (F.col("doc_id") >= poor).cast("int"))
    ranking = quality.learn(docs, marks, "quality", F.lit(True))
    x = np.stack([r[0] for r in docs.select(quality.shape("text")).collect()])
    s = np.sort(ranking.strength(x))
    # The cut lies exactly where as many texts are below as have poor labels, over all texts.
    assert s[poor - 1] < ranking.cut < s[poor] and np.isclose(ranking.cut, (s[poor - 1] + s[poor]) / 2)
    assert np.isclose(ranking.slope, 4 / s.std())


def test_every_label_is_in_a_block(spark):
    figures = lambda i: [float(i)] * quality.FIGURES
    rows = spark.createDataFrame([(i, int(i >= 3), figures(i)) for i in range(4500)] + [(7, 1, figures(7))], "doc_id long, mark int, x array<double>")
    blocks = quality.dealt(rows, {0: 3, 1: 4498}).collect()
    held = [[np.frombuffer(v).reshape(-1, quality.FIGURES)[:, 0].astype(int).tolist() for v in (b.good, b.poor)] for b in blocks]
    assert len(held) == 5 and all(good and poor for good, poor in held)
    assert sorted(i for good, _ in held for i in good) == sorted([*range(3, 4500), 7])
    assert {i for _, poor in held for i in poor} == {0, 1, 2} and sum(len(poor) for _, poor in held) == 5
    mean, unit, w = np.zeros(quality.FIGURES), np.full(quality.FIGURES, 1e-3), np.full(quality.FIGURES, 0.01)
    pairs, slope, bend = quality.bends(spark.createDataFrame(blocks), mean, unit, w)
    x = np.array([(a - b) * 1e-3 for good, poor in held for a in good for b in poor])
    p = 1 / (1 + np.exp(-x * w.sum()))
    assert pairs == len(x) and np.allclose(slope, ((1 - p) * x).sum()) and np.allclose(bend, (p * (1 - p) * x * x).sum())


def test_ranked_finds_order_statistics(spark):
    values = np.concatenate([np.random.default_rng(6).normal(size=700), np.zeros(40), [1e9, -1e9]])
    rows = spark.createDataFrame([(float(v),) for v in values], "s double")
    assert all(quality.ranked(rows, k) == np.sort(values)[k] for k in (0, 1, 350, 360, 741))


def test_block_max_finds_the_nearest():
    rng = np.random.default_rng(2)
    ids = [np.sort(rng.choice(40, int(rng.integers(1, 8)), replace=False)) for _ in range(900)]
    weights = [(lambda w: w / np.linalg.norm(w))(rng.random(len(i)) + 0.1) for i in ids]
    dense = np.zeros((900, 40))
    for r, (i, w) in enumerate(zip(ids, weights)):
        dense[r, i] = w
    index = toxicity.BlockMax(ids, weights, np.zeros(900, np.int64), np.arange(900), 40)
    for q in range(0, 900, 37):
        rows, sims = index.nearest(ids[q], weights[q], 10, but=q)
        cosine = dense @ dense[q]
        cosine[q] = -1
        want = np.sort(cosine[cosine > 0])[::-1][:10]
        assert np.allclose(sims, want) and np.allclose(cosine[index.names[rows]], sims)


def test_toxicity_of_unseen_texts(spark, table, odd):
    rng = np.random.default_rng(3)
    bad, plain = [f"bad{i}" for i in range(6)], [f"word{i}" for i in range(400)]
    texts = []
    for i in range(400):
        y = int(i % 4 == 0)
        texts.append((" ".join([*rng.choice(plain, 30), *(rng.choice(bad, 3) if y else [])]) + "!", y))
    docs, marks = labelled(spark, table, texts, "toxic")
    model = toxicity.learn(docs, marks, "toxic", words.bucket_of_id("doc_id", 4) != 2)
    rows = toxicity.score(docs.withColumn("toxicity", F.lit(1)), model).collect()
    assert sum((r.toxicity.score >= toxicity.CUT) == (texts[r.doc_id][1] == 1) for r in rows) >= 0.98 * len(rows)
    assert all(e.label in (0, 1) and 0 < e.similarity < 1.0001 for r in rows for e in r.toxicity.evidence)
    scores = [r.toxicity.score for r in toxicity.score(odd, model).collect()]
    assert len(scores) == odd.count() and all(0 <= s < toxicity.CUT for s in scores)


@pytest.mark.parametrize("marks", [[], [(1, 0)], [(1, 1), (2, 1)]])
def test_toxicity_with_labels_of_one_kind(spark, table, marks):
    docs = table([(1, "some words here"), (2, None)])
    model = toxicity.learn(docs, spark.createDataFrame(marks, "doc_id long, toxic int"), "toxic", F.lit(True))
    assert all(0 <= r.toxicity.score <= 1 for r in toxicity.score(docs, model).collect())


def test_gains_equal_the_change_of_likelihood():
    rng = np.random.default_rng(4)
    k, n = 5, 30
    pairs = rng.integers(0, 6, (n, n)).astype(float)
    np.fill_diagonal(pairs, 0)
    classes = rng.integers(0, k, n)

    def likelihood(c):
        table = np.zeros((k, k))
        np.add.at(table, (c[:, None].repeat(n, 1), c[None, :].repeat(n, 0)), pairs)
        return table, classmodel.xlogx(table).sum() - classmodel.xlogx(table.sum(0)).sum() - classmodel.xlogx(table.sum(1)).sum()

    table, now = likelihood(classes)
    for w in range(n):
        before, after = np.bincount(classes, pairs[:, w], k), np.bincount(classes, pairs[w], k)
        found = classmodel.gains(table, before, after, classes[w])
        for c in range(k):
            moved = classes.copy()
            moved[w] = c
            assert math.isclose(found[c], likelihood(moved)[1] - now, abs_tol=1e-6)


def test_every_numbered_word_is_exchanged(spark, table):
    """Rare words, far behind the most frequent ones, end in the classes that their neighbours call for."""
    rng = np.random.default_rng(9)
    rows = [" ".join(f"{'ab'[j % 2]}{rng.integers(0, 2600)}" for j in range(40)) for _ in range(1300)]
    docs = table(list(enumerate(rows))).select("doc_id", "text", F.lit(False).alias("held_out"))
    head = classmodel.head_of(classmodel.counted(docs))
    texts = classmodel.encoded(docs, head)
    assert head.size > 5000
    classes = classmodel.cluster(texts, head)
    names = dict(zip(head.hashes.tolist(), classes.tolist()))
    kinds = [[names[int(h)] for h in words.hashes([f"{k}{i}".encode() for i in range(2600)]) if int(h) in names] for k in "ab"]
    mixed = [min(kinds[0].count(c), kinds[1].count(c)) for c in range(classmodel.CLASSES)]
    assert sum(mixed) <= 0.02 * head.size and classes[head.size + 1] == classmodel.CLASSES
    # The lists hold every pair of neighbours, counted in both directions.
    lists = [classmodel.Lists.of(r.rows) for r in classmodel.neighbour_lists(texts, head.size, 10).collect()]
    want = collections.Counter(p for row in rows for p in zip([None, *row.encode().split()], [*row.encode().split(), None]))
    number = {None: head.size} | {w: int(head.number(words.hashes([w]))[0]) for row in rows for w in row.encode().split()}
    found = {(int(a), int(s), int(b)): int(c) for x in lists for a, s, b, c in zip(x.word, x.side, x.other, x.n)}
    assert found == {k: c for (a, b), c in want.items() for k in ((number[a], 1, number[b]), (number[b], 0, number[a]))}


def test_language_model(table, odd):
    rng = np.random.default_rng(5)
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    # Two kinds of words in turn: classes know what a word alone does not.
    for i in range(300):
        n = int(rng.integers(5, 40))
        rows.append((100 + i, " ".join(f"{'ab'[(i + j) % 2]}{rng.integers(0, 30)}" for j in range(n))))
    docs = table(rows)
    held = words.bucket_of_id("doc_id", 5) == 1
    found = classmodel.score(docs, held).collect()
    counts = collections.Counter()
    flags = [r[0] for r in docs.select(held).collect()]
    for (_, text), out in zip(rows, flags):
        if not out:
            counts.update([*(text or "").encode().lower().split(), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for (doc, text), out in zip(rows, flags):
        tokens = [*(text or "").encode().lower().split(), None]
        base = sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        want.append((doc, out, len(tokens), sum(counts[t] > 0 for t in tokens), n, round(base, 6)))
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found), key=str) == sorted(want, key=str)
    unseen = [r for r in found if r.held_out and r.doc_id and r.doc_id >= 100]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen) + 0.1 * sum(r.n_tokens for r in unseen)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)


def test_transitions_and_emissions_add_up(spark, table):
    docs = table([(i, f"a b c{i % 7} d") for i in range(60)]).select("doc_id", "text", F.lit(False).alias("held_out"))
    counts = classmodel.counted(docs)
    head = classmodel.head_of(counts)
    model = classmodel.fit(classmodel.encoded(docs, head), head, 300, 11, 60)
    assert np.allclose((10**model.transition).sum(axis=1), 1)
    own = model.classes[: head.size]
    sums = np.bincount(own, 10 ** model.emission[: head.size], classmodel.CLASSES + 2)
    assert np.allclose(sums[np.unique(own)], 1)


def test_language_model_with_nothing_to_learn(table):
    docs = table([(1, "some text"), (2, None)])
    rows = classmodel.score(docs, F.lit(True)).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in rows] == [(0, 0, 0.0)] * 2
    assert classmodel.score(docs.limit(0), F.lit(False)).count() == 0


def test_words_tied_at_the_cut_are_numbered_by_hash(spark):
    counts = spark.range(10_000).select(F.xxhash64("id").alias("h"), F.when(F.col("id") < 10, 50).otherwise(3).cast("long").alias("c"))
    head = counts.where(classmodel.frequent(counts, 2000))
    assert head.where("c = 50").count() == 10 and 1800 <= head.count() <= 2200
    assert counts.where(classmodel.frequent(counts, 10_000)).count() == 10_000
    # Where all words are tied, some are numbered all the same.
    assert 900 <= counts.where("c = 3").where(classmodel.frequent(counts.where("c = 3"), 1000)).count() <= 1100
