"""Similarity join, shards, neighbours and components against brute force."""

from __future__ import annotations

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stallwise.llm import components, jaccard, sharding, vectors


def brute_groups(rows, k, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[max(top(i), top(j))] = min(top(i), top(j))
    ids = collections.defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        ids[top(i)].append(doc)
    name = {i: min((d for d in g if d is not None), default=None) for i, g in ids.items()}
    return sorted(((doc, len(s), name[top(i)] if s else doc) for i, ((doc, _), s) in enumerate(zip(rows, sets))), key=str)


@pytest.mark.parametrize("k, percent", [(3, 90), (5, 80)])
def test_similar(table, odd, k, percent):
    rng = np.random.default_rng(k)
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    for group in range(12):
        base = [f"w{x}" for x in rng.integers(0, 500, int(rng.integers(2, 150)))]
        for copy in range(9):
            text = list(base)
            for _ in range(copy // 2):
                text[int(rng.integers(0, len(text)))] = f"x{rng.integers(0, 10**6)}"
            rows.append((1000 + group * 20 + copy, " ".join(text).upper() if copy % 3 else "\t".join(text)))
    found = jaccard.similar(table(rows), k, percent).collect()
    assert sorted(map(tuple, found), key=str) == brute_groups(rows, k, percent)


def test_similar_in_one_large_group(table):
    # Many copies that differ from each other in places of their own: links run over the centre only.
    base = [f"w{i}" for i in range(80)]
    rows = [(0, " ".join(base))]
    for i in range(1, 150):
        text = list(base)
        text[i % 80] = f"x{i}"
        if i % 3 == 0:
            text[(i * 7) % 80] = f"y{i}"
        rows.append((i, " ".join(text)))
    assert sorted(map(tuple, jaccard.similar(table(rows), 3, 90).collect()), key=str) == brute_groups(rows, 3, 90)


def test_similar_where_many_share_a_passage_and_do_not_link(table):
    rng = np.random.default_rng(8)
    passage = " ".join(f"shared{i}" for i in range(14))
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 10**6, 20)) + " " + passage) for i in range(250)]
    rows += [(1000 + i, rows[i][1] + " end") for i in range(0, 40, 4)]
    assert sorted(map(tuple, jaccard.similar(table(rows), 3, 90).collect()), key=str) == brute_groups(rows, 3, 90)


def test_counting_rare_shingles_by_few_or_many_buckets(table):
    rng = np.random.default_rng(9)
    docs = table([(i, " ".join(f"w{x}" for x in rng.integers(0, 300, 60))) for i in range(60)] + [(100, None), (101, "a b c")])
    few, many = (sorted((bytes(r.digest), r.alone) for r in jaccard._rare(docs, 3, 90, n).collect()) for n in (1, 5000))
    assert few == many and len(few) > 30


def test_similar_of_an_empty_table(table):
    assert jaccard.similar(table([])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 105), (105, 101), (7, 7), (200, 200), (None, 3)]
    found = dict(map(tuple, components.connected(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert found == {i: 0 for i in range(61)} | {100: 100, 101: 100, 105: 100, 200: 200}


def test_difference_is_tight():
    rng = np.random.default_rng(2)
    sizes = [int(x) for x in rng.integers(1, 10_000, 3000)]
    shard = sharding.difference(sizes, 16)
    sums = np.bincount(shard, sizes, 16)
    assert sums.max() - sums.min() <= 2
    # Karmarkar and Karp's own example: 8, 7, 6, 5, 4 in two parts differ by 2.
    two = np.bincount(sharding.difference([8, 7, 6, 5, 4], 2), [8, 7, 6, 5, 4], 2)
    assert abs(two[0] - two[1]) == 2
    assert sharding.difference([], 4) == [] and sharding.difference([9], 4) == [sharding.difference([9], 4)[0]]


def test_shards(table, odd):
    rng = np.random.default_rng(4)
    docs = odd.union(table([(100 + i, "t" * int(x)) for i, x in enumerate(rng.integers(1, 400, 700))] + [(900, "hot group")] * 300))
    rows = sharding.balanced(docs, 4).collect()
    texts = collections.defaultdict(set)
    want = sorted(((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect()), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == want
    for r in rows:
        texts[r.size, r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in texts.values())
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    # The two long texts fill two shards; the rest is level in the others.
    sums = sorted(sum(r.size for r in rows if r.shard == s) for s in range(4))
    assert sums[1] - sums[0] <= 10 and sums[3] == 300_001


def test_shards_of_rows_that_are_all_alike(table):
    rows = sharding.balanced(table([(None, "same")] * 400), 4).collect()
    assert len({r.shard for r in rows}) == 1 and sorted(r.slot for r in rows) == list(range(400))


def test_shards_of_an_empty_table(table):
    assert sharding.balanced(table([])).count() == 0


def brute_neighbours(rows, k, every):
    keep = {i: np.array(v, float) for i, v in rows}
    out = []
    for i, q in keep.items():
        if i % every == 0:
            near = sorted((-float(q @ v / (np.linalg.norm(q) * np.linalg.norm(v))), j) for j, v in keep.items() if j != i and len(v) == len(q))
            out += [(i, r + 1, j) for r, (_, j) in enumerate(near[:k])]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(1500, 16)).astype(np.float32)
    points[100:160] = points[100]
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    odd = [(5000, None), (5050, [0.0] * 16), (5100, [float("nan")] * 16), (5150, [None, *[1.0] * 15]), (5200, [float("inf")] * 16), (None, [1.0] * 16), (5250, [])]
    df = spark.createDataFrame(rows + odd + rows[:3], "vec_id long, embedding array<float>").withColumn("score", F.lit("x")).withColumn("shard", F.lit(1))
    found = [(r.query_id, r.rank, r.vec_id) for r in vectors.nearest(df, 5, 50).collect()]
    want = brute_neighbours(rows, 5, 50)
    assert len(found) == len(want) and {q for q, _, _ in found} == {q for q, _, _ in want}
    assert len({(q, v) for q, _, v in found} & {(q, v) for q, _, v in want}) >= 0.95 * len(want)
    # All copies of one vector: exact, in order of their ids.
    assert sorted(x for x in found if x[0] == 100) == [(100, r, 100 + r) for r in range(1, 6)]


def test_neighbours_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD", 300)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(40, 24))
    points = centres[rng.integers(0, 40, 2000)] + 0.4 * rng.normal(size=(2000, 24))
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {(r.query_id, r.vec_id) for r in vectors.nearest(df, 5, 50).collect()}
    want = {(q, v) for q, _, v in brute_neighbours(rows, 5, 50)}
    assert len(found) == len(want) and len(found & want) >= 0.95 * len(want)


def test_few_neighbours(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (50, [1.0, 1.0, 1.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in vectors.nearest(df).collect()] == [(0, 1, 1, 0.0)]
    assert vectors.nearest(df.limit(0)).count() == 0
