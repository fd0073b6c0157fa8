"""Toxicity of documents by their nearest labelled examples under exact TF-IDF cosine.

Terms are words whose presence depends on the label (chi-squared), at most TERMS; their document frequencies cover all
documents. The examples, at most SAMPLE distinct labelled texts, lie in blocks of similar vectors, and an inverted
index holds each term's largest weight per block. A document adds these up to a bound per block, opens the blocks of
the highest bounds, then all others that can still hold a nearer example: the K nearest found are exact. They vote by
distance, and a logistic curve fitted on leave-one-out votes turns votes into scores.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.sources import scratch

SAMPLE = 20_000
PARTS = 16
TERMS = 4096
# Chi-squared of one degree of freedom at one in 10,000, and the fewest examples that show a term.
DEPENDENT = 15.1
SHOWN = 3
BLOCK = 64
# Blocks opened before the floor is known.
FIRST = 8
K = 15
CUT = 0.3
SPLIT = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(128)) + bytes(range(128, 256))
SCHEMA = "score double, evidence array<struct<doc_id:long,similarity:double,label:int>>"


def terms(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(SPLIT).split()


def vector(text: str | None, place: dict[bytes, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted term numbers and unit weights (1 + ln tf) * idf; a text without any known term is empty."""
    found = Counter(place[w] for w in terms(text) if w in place)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0)
    ids = np.array(sorted(found))
    weights = (1 + np.log([found[i] for i in ids])) * idf[ids]
    return ids, weights / np.linalg.norm(weights)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges (start, size), one range after the other."""
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class BlockMax:
    """Examples in blocks, with each term's largest weight per block."""

    def __init__(self, ids: list[np.ndarray], weights: list[np.ndarray], labels: np.ndarray, names: np.ndarray, terms: int) -> None:
        # Neighbours in this order share their heaviest terms, which keeps the bounds of a block tight.
        order = sorted(range(len(ids)), key=lambda i: (tuple(ids[i][np.argsort(-weights[i], kind="stable")][:4]), names[i]))
        self.labels, self.names = labels[order], names[order]
        sizes = np.array([len(ids[i]) for i in order], np.int64)
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        self.term = np.concatenate([ids[i] for i in order]) if order else np.zeros(0, np.int64)
        self.weight = np.concatenate([weights[i] for i in order]) if order else np.zeros(0)
        self.row = np.repeat(np.arange(len(order)), sizes)
        self.blocks = -(-len(order) // BLOCK)
        # Postings by term, then row; one entry for each term and block names its span of them and its largest weight.
        by_term = np.argsort(self.term, kind="stable")
        self.post_row, self.post_weight = self.row[by_term], self.weight[by_term]
        key = self.term[by_term] * max(1, self.blocks) + self.post_row // BLOCK
        distinct, self.span_start, self.span_size = np.unique(key, return_index=True, return_counts=True)
        self.span_block = distinct % max(1, self.blocks)
        self.span_max = np.maximum.reduceat(self.post_weight, self.span_start) if len(key) else np.zeros(0)
        self.term_start = np.searchsorted(distinct // max(1, self.blocks), np.arange(terms + 1))

    def nearest(self, ids: np.ndarray, weights: np.ndarray, k: int, but: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k rows of largest positive cosine, ties to the smaller name; `but` names an example to leave out."""
        if not len(ids) or not self.blocks:
            return np.zeros(0, np.int64), np.zeros(0)
        sizes = self.term_start[ids + 1] - self.term_start[ids]
        spans, factor = _ranges(self.term_start[ids], sizes), np.repeat(weights, sizes)
        bound = np.bincount(self.span_block[spans], factor * self.span_max[spans], self.blocks)
        # The most promising blocks give the floor that lets most others stay shut.
        first = np.zeros(self.blocks, bool)
        first[np.argsort(-bound, kind="stable")[:FIRST]] = True
        rows, sims = self._best(*self._open(first & (bound > 0), spans, factor), k, but)
        floor = sims[k - 1] - 1e-9 if len(sims) >= k else 0.0
        rest = ~first & (bound > floor)
        if rest.any():
            more, near = self._open(rest, spans, factor)
            rows, sims = self._best(np.concatenate([rows, more]), np.concatenate([sims, near]), k, but)
        return rows, sims

    def _open(self, blocks: np.ndarray, spans: np.ndarray, factor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the given blocks with a positive cosine, and that cosine."""
        inside = blocks[self.span_block[spans]]
        spans, factor = spans[inside], factor[inside]
        sizes = self.span_size[spans]
        posts = _ranges(self.span_start[spans], sizes)
        sim = np.bincount(self.post_row[posts], np.repeat(factor, sizes) * self.post_weight[posts], len(self.labels))
        hit = np.flatnonzero(sim > 0)
        return hit, sim[hit]

    def _best(self, rows: np.ndarray, sims: np.ndarray, k: int, but: int | None) -> tuple[np.ndarray, np.ndarray]:
        if but is not None:
            other = self.names[rows] != but
            rows, sims = rows[other], sims[other]
        if len(rows) > 4 * k:
            near = sims >= np.partition(sims, len(sims) - k)[len(sims) - k] - 1e-9
            rows, sims = rows[near], sims[near]
        best = np.lexsort((self.names[rows], -sims.round(12)))[:k]
        return rows[best], sims[best]


def vote(sims: np.ndarray, labels: np.ndarray, prior: float) -> float:
    """Share of toxic neighbours, weighted by the inverse of their distance, with one neighbour's worth of prior."""
    weights = 1 / (1.05 - sims)
    return float(((weights * labels).sum() + prior) / (weights.sum() + 1))


def calibrate(votes: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve from log-odds of votes to labels, lightly held to the identity."""
    slope, offset = 1.0, 0.0
    x = np.log(votes / (1 - votes))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -30, 30)))
        g = np.array([((labels - p) * x).sum() - (slope - 1), (labels - p).sum() - offset])
        v = p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1, (v * x).sum()], [(v * x).sum(), v.sum() + 1]])
        step = np.linalg.solve(h, g)
        slope, offset = slope + float(step[0]), offset + float(step[1])
        if np.abs(step).max() < 1e-8:
            break
    return max(slope, 1e-3), offset


@dataclass
class Model:
    place: dict[bytes, int]
    idf: np.ndarray
    index: BlockMax
    prior: float
    slope: float = 1.0
    offset: float = 0.0

    def near(self, text: str | None, but: int | None = None) -> tuple[float, np.ndarray, np.ndarray]:
        rows, sims = self.index.nearest(*vector(text, self.place, self.idf), K, but)
        return vote(sims, self.index.labels[rows], self.prior), rows, sims

    def score(self, raw: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * math.log(raw / (1 - raw)) + self.offset))))


def _examples(docs: DataFrame, labels: DataFrame, label: str, train: Column) -> DataFrame:
    """(doc_id, text, mark): labelled texts, at most SAMPLE by a hash of the id; equal texts are one with their mean label."""
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.avg(label).alias("mark")).where(train)
    marked = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # Bounded by SAMPLE rows of two numbers.
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(marked), "doc_id")
    rows = rows.groupBy("text").agg(F.min("doc_id").alias("doc_id"), (F.avg("mark") >= 0.5).cast("int").alias("mark"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)


def _vocabulary(examples: DataFrame) -> list[bytes]:
    """Terms that depend on the label, the most dependent first."""

    def shown(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bad, good = Counter(), Counter()
            for text, mark in zip(batch["text"], batch["mark"]):
                (bad if mark else good).update(set(terms(text)))
            every = list(bad | good)
            yield pd.DataFrame({"term": every, "bad": [bad[t] for t in every], "good": [good[t] for t in every]})

    totals = examples.agg(F.sum("mark"), F.count("*")).first()
    bad, n = float(totals[0] or 0), float(totals[1])
    if not bad or bad == n:
        return []
    counts = examples.select("text", "mark").mapInPandas(shown, "term binary, bad long, good long")
    counts = counts.groupBy("term").agg(F.sum("bad").cast("double").alias("a"), F.sum("good").cast("double").alias("b"))
    cross = F.col("a") * (n - bad - F.col("b")) - F.col("b") * (bad - F.col("a"))
    df = F.col("a") + F.col("b")
    chi = n * cross * cross / (bad * (n - bad) * df * (n - df))
    found = counts.where((df >= SHOWN) & (df < n)).withColumn("chi", chi).where(F.col("chi") >= DEPENDENT)
    return [bytes(r.term) for r in found.orderBy(F.desc("chi"), "term").limit(TERMS).collect()]


def learn(docs: DataFrame, labels: DataFrame, label: str, train: Column) -> Model:
    """Fit on labelled documents for which `train` holds. No labels at all, or of one kind, give scores of that kind."""
    spark = docs.sparkSession
    # Bounded by SAMPLE texts; cut once, as four passes read it.
    examples = scratch.cut(_examples(docs, labels, label, train).repartition(PARTS))
    vocabulary = _vocabulary(examples)
    place = {term: i for i, term in enumerate(vocabulary)}

    def document_frequency(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, n = np.zeros(len(place), np.int64), 0
        for batch in batches:
            n += len(batch)
            for text in batch["text"]:
                own = {place[w] for w in terms(text) if w in place}
                counts[list(own)] += 1
        yield pd.DataFrame({"i": np.arange(-1, len(place)), "n": np.concatenate([[n], counts])})

    sums = docs.select("text").mapInPandas(document_frequency, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(len(place) + 1)
    df[sums["i"].to_numpy() + 1] = sums["n"].to_numpy()
    idf = np.log((1 + df[0]) / (1 + df[1:])) + 1

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [vector(text, place, idf) for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "mark": batch["mark"], "ids": [v[0] for v in made], "weights": [v[1] for v in made]})

    rows = examples.mapInPandas(vectors, "doc_id long, mark int, ids array<long>, weights array<double>").toPandas()
    rows = rows.sort_values("doc_id", ignore_index=True)
    marks = rows["mark"].to_numpy(np.int64)
    prior = (marks.sum() + 0.5) / (len(marks) + 10)
    some = rows[rows["ids"].map(len) > 0]
    index = BlockMax(
        [np.asarray(x, np.int64) for x in some["ids"]], [np.asarray(x) for x in some["weights"]],
        some["mark"].to_numpy(np.int64), some["doc_id"].to_numpy(np.int64), len(place),
    )
    model = Model(place, idf, index, float(prior))
    if place:
        shipped = spark.sparkContext.broadcast(cloudpickle.dumps(model))

        def votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            held = cloudpickle.loads(shipped.value)
            for batch in batches:
                own = [held.index.nearest(np.asarray(i, np.int64), np.asarray(w), K, d) for d, i, w in zip(batch["doc_id"], batch["ids"], batch["weights"])]
                raw = [vote(s, held.index.labels[r], held.prior) for r, s in own]
                yield pd.DataFrame({"raw": raw, "mark": batch["mark"]})

        asked = examples.mapInPandas(vectors, "doc_id long, mark int, ids array<long>, weights array<double>")
        left_out = asked.mapInPandas(votes, "raw double, mark int").toPandas().sort_values(["raw", "mark"])
        model.slope, model.offset = calibrate(left_out["raw"].to_numpy(), left_out["mark"].to_numpy())
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add `toxicity`: struct of `score` (0 to 1) and `evidence` (the nearest examples, nearest first).

    A text without any term of the vocabulary, an empty or a NULL one has no evidence and the score of the prior.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    @F.pandas_udf(SCHEMA)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held = cloudpickle.loads(shipped.value)
        for batch in batches:
            scores, evidence = [], []
            for value in batch:
                raw, rows, sims = held.near(value)
                scores.append(held.score(raw))
                evidence.append([
                    {"doc_id": int(held.index.names[r]), "similarity": float(s), "label": int(held.index.labels[r])} for r, s in zip(rows, sims)
                ])
            yield pd.DataFrame({"score": scores, "evidence": evidence})

    return docs.withColumn("toxicity", run(F.col(f"`{text}`")))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
