"""Document quality by Bradley-Terry ranking of preference pairs.

Every text becomes a row of shape figures (shares of signs, letters, repeats, lengths). A linear strength w.x is learnt
from pairs of a good and a poor labelled text: the chance that the good one wins is logistic in the difference of their
figures. All labelled texts are dealt into blocks that hold both kinds, and all pairs of a block are compared. The cut
is a quantile of all labelled strengths, at the share of poor labels; scores are squeezed so that the cut lies at CUT.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwise.llm import words
from stallwise.operators import ordered
from stallwise.sources import scratch

# Labelled rows of a block, within which every good one is compared with every poor one, and rows that a task is worth.
BLOCK = 1000
ROWS = 20_000
# Ranges that an order statistic is narrowed by in one pass.
RANGES = 1024
RIDGE = 1e-3
CUT = 0.3
SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FIGURES = len(SIGNS) + 18


def figures(text: bytes) -> np.ndarray:
    """The shape of one text; an empty one is all zeros but for its own mark."""
    out = np.zeros(FIGURES)
    if not text:
        out[-1] = 1.0
        return out
    size = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    n, m = max(1, len(words)), max(1, len(lines))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    sign = counts[list(SIGNS)]
    # A sign per word tells more than a sign per byte; the square root tames single outliers.
    out[: len(SIGNS)] = np.sqrt(sign / n)
    upper, lower, digit = counts[65:91].sum(), counts[97:123].sum(), counts[48:58].sum()
    distinct = len(set(words))
    top = 0
    if words:
        _, repeats = np.unique(lengths, return_counts=True)
        top = repeats.max()
    tail = [
        upper / size, lower / size, digit / size, counts[128:].sum() / size, counts[10] / size, sign.sum() / size,
        counts[:32].sum() / size, distinct / n, len(set(lines)) / m, lengths.mean() / 10, lengths.std() / 10,
        min(1.0, lengths.max() / 100), (lengths <= 3).sum() / n, math.log1p(n) / 10, math.log1p(m) / 10, top / n,
        math.log1p(size / m) / 10, 0.0,
    ]
    out[len(SIGNS) :] = tail
    return out


@F.pandas_udf(T.ArrayType(T.DoubleType()))
@words.tidy
def shape(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in batches:
        yield pd.Series([figures((text or "").encode("utf-8", "replace")) for text in batch], dtype=object)


@dataclass(frozen=True)
class Ranking:
    """Strength w.(x - mean) / scale; the cut in strength; the slope of the squeeze."""

    weights: list[float]
    cut: float
    slope: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return x @ np.asarray(self.weights)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.strength(x) - self.cut) + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def dealt(rows: DataFrame, sizes: dict[int, int]) -> DataFrame:
    """(block, good, poor): labelled figures packed in blocks of about BLOCK rows, each of which holds both kinds.

    Rows are numbered by a hash of their id and dealt out in turn, so every labelled row is in a block and blocks are
    alike. A kind that has fewer rows than there are blocks goes round again until each block has one.
    """
    blocks = math.ceil(sum(sizes.values()) / BLOCK)
    named = rows.select("mark", F.xxhash64("doc_id").alias("h"), "doc_id", F.xxhash64("x").alias("shape"), "x")
    numbered = ordered.row_numbers(named, ["mark"], ["h", "doc_id", "shape"], "at")
    turn = F.when(F.col("mark") == 1, F.lit(sizes[1])).otherwise(F.lit(sizes[0])).cast("long")
    placed = numbered.select("mark", "at", "x", F.explode(F.sequence((F.col("at") - 1) % blocks, F.lit(blocks - 1).cast("long"), turn)).alias("block"))

    def pack(held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values(["mark", "at"])
        good, poor = (np.stack(held["x"][held["mark"] == mark].to_numpy()).tobytes() for mark in (1, 0))
        return pd.DataFrame({"block": held["block"].iloc[:1], "good": [good], "poor": [poor]})

    return placed.groupBy("block").applyInPandas(pack, "block long, good binary, poor binary")


def bends(blocks: DataFrame, mean: np.ndarray, unit: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Pairs, and the first two derivatives of their logistic likelihood at `w`: every good row of a block against every poor one.

    A task sums up its blocks, so a row of FIGURES squared numbers per task reaches the driver. The differences of the
    figures are never made: sums over pairs fall apart into sums over rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, slope, bend = 0, np.zeros(FIGURES), np.zeros((FIGURES, FIGURES))
        for batch in batches:
            for packed in zip(batch.column("good"), batch.column("poor")):
                good, poor = ((np.frombuffer(v.as_py()).reshape(-1, FIGURES) - mean) * unit for v in packed)
                miss = 1 / (1 + np.exp(np.clip((good @ w)[:, None] - (poor @ w)[None, :], -30, 30)))
                weight = miss * (1 - miss)
                pairs += miss.size
                slope += miss.sum(axis=1) @ good - miss.sum(axis=0) @ poor
                cross = good.T @ weight @ poor
                bend += (good * weight.sum(axis=1)[:, None]).T @ good + (poor * weight.sum(axis=0)[:, None]).T @ poor - cross - cross.T
        yield pa.RecordBatch.from_pydict({"pairs": [pairs], "slope": [slope.tobytes()], "bend": [bend.tobytes()]})

    found = blocks.select("good", "poor").mapInArrow(run, "pairs long, slope binary, bend binary").collect()
    slope = np.sum([np.frombuffer(r.slope) for r in found], axis=0)
    bend = np.sum([np.frombuffer(r.bend) for r in found], axis=0).reshape(FIGURES, FIGURES)
    return sum(r.pairs for r in found), slope, bend


def logistic(blocks: DataFrame, mean: np.ndarray, unit: np.ndarray, ridge: float, rounds: int = 25) -> np.ndarray:
    """Weights of the logistic loss over all pairs within blocks, by Newton steps of one Spark job each."""
    w = np.zeros(FIGURES)
    for _ in range(rounds):
        pairs, slope, bend = bends(blocks, mean, unit, w)
        step = np.linalg.solve(bend / pairs + ridge * np.eye(FIGURES), slope / pairs - ridge * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def ranked(values: DataFrame, place: int) -> float:
    """The value of `s` at `place` (from 0) among all rows in order: counts by range, narrowed until one value is left."""
    low, high = values.agg(F.min("s"), F.max("s")).first()
    while low < high:
        spot = F.least(F.floor((F.col("s") - low) / (high - low) * RANGES), F.lit(RANGES - 1)).alias("spot")
        inside = values.where(F.col("s").between(low, high)).groupBy(spot)
        for row in inside.agg(F.count("*").alias("n"), F.min("s").alias("low"), F.max("s").alias("high")).orderBy("spot").collect():
            if place < row.n:
                low, high = row.low, row.high
                break
            place -= row.n
    return low


def fit(rows: DataFrame, sizes: dict[int, int]) -> Ranking:
    """Learn from all labelled figures (doc_id, mark, x); `sizes` counts each kind. Nothing but sums reaches the driver.

    With no pair of labels to compare, all texts are of equal strength and pass.
    """
    if not sizes[0] or not sizes[1]:
        return Ranking([0.0] * FIGURES, -1.0 if sizes[1] or not sizes[0] else 1.0, 1.0)
    n = sum(sizes.values())
    moments = rows.agg(*[F.avg(F.col("x")[i]) for i in range(FIGURES)], *[F.stddev_pop(F.col("x")[i]) for i in range(FIGURES)]).first()
    mean, scale = np.array(moments[:FIGURES]), np.array(moments[FIGURES:])
    unit = np.where(scale > 1e-9, 1 / np.maximum(scale, 1e-9), 0.0)
    blocks = scratch.cut(dealt(rows, sizes).coalesce(1 + n // ROWS))
    w = logistic(blocks, mean, unit, RIDGE) * unit

    @F.pandas_udf("double")
    def strength(x: pd.Series) -> pd.Series:
        return pd.Series(np.stack(x.to_numpy()) @ w if len(x) else np.zeros(0))

    values = scratch.cut(rows.select(strength("x").alias("s")))
    # As many texts are to lie below the cut as have poor labels. It lies in the middle of the gap above the last of them.
    cut = ranked(values, sizes[0] - 1)
    above, spread = values.agg(F.min(F.when(F.col("s") > cut, F.col("s"))), F.stddev_pop("s")).first()
    if above is not None:
        cut = (cut + above) / 2
    return Ranking([float(v) for v in w], cut, 4.0 / (spread or 1.0))


def learn(docs: DataFrame, labels: DataFrame, label: str, train: Column) -> Ranking:
    """Fit on all labelled texts for which `train`, a condition on doc_id, holds.

    Labels NULL or without a document are left out; several labels of one id are averaged, and half counts as 1.
    """
    marked = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("mark")).where(train)
    # Figures are taken before the join, so no text is shuffled.
    shaped = docs.where(train).where("doc_id is not null").select("doc_id", shape("text").alias("x"))
    rows = scratch.cut(shaped.join(marked, "doc_id").select("doc_id", "mark", "x"))
    sizes = {0: 0, 1: 0} | {r.mark: r["count"] for r in rows.groupBy("mark").count().collect()}
    return fit(rows, sizes)


def score(text: Column, ranking: Ranking) -> Column:
    """The score of each text, 0 to 1; empty and NULL texts get one too."""

    @F.pandas_udf("double")
    @words.tidy
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            x = [figures((value or "").encode("utf-8", "replace")) for value in batch]
            yield pd.Series(ranking.score(np.stack(x)) if x else np.zeros(0))

    return run(text)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
