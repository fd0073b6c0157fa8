"""Benchmark decontamination: passages of a text within a word edit distance of a benchmark item.

A random walk embeds a word sequence so that edit distance becomes Hamming distance: at each step it writes the word it
stands on and moves on by a random bit of (step, word). Bit-sampling tables over the embeddings of all windows of a
text retrieve items, and an exact alignment verifies each. The more edits a walk has met, the less likely it is in step
again, so items are embedded in stretches of at most STRETCH words: one stretch of an item has no more than its share of
the edits, and each is a chance of its own. An edit spoils at most two word pairs, so a window that holds fewer pairs of
any item than a stretch has left with its share of edits spent is never embedded; that loses nothing. Items too short
for an edit are found by an equality hash of their windows.

Words are lower-cased runs of letters and digits; in scripts without spaces each letter is a word. A word of no item is
a symbol of its own in the walk.
"""

from __future__ import annotations

import bisect
import re
import sys
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.llm import words

# An item is found at an edit distance of up to this share of its words.
EDITS = 0.2
# Shorter items have no edits and are matched exactly.
LEAST_WORDS = 5
STRETCH = 24
WALKS = 16
TABLES = 64
SAMPLED = 3
# Steps of the walk per word of the shortest stretch of a length class; classes grow by this factor.
PACE = 1.2
GROWTH = 1.25
# Words of items that one pass over the texts holds.
ITEM_WORDS = 500_000
# Bytes of text worked on at once.
CHUNK = 2_000_000
SPLIT = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(128)) + bytes(range(128, 256))
# Scripts written without spaces (Thai to Myanmar, Khmer, kana and Han with their extensions), and signs
# beyond ASCII that part words.
LETTERS = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u2e80-\u2fdf\u3040-\u312f\u31a0-\u31ff\u3400-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
SIGNS = re.compile(r"[^\x00-\x7f\w]")
PAD = -2
LEAKS = "array<struct<item_id:long,distance:int,item_words:int,first_word:int,last_word:int>>"


def split(text: str | None) -> list[bytes]:
    """Lower-cased words; punctuation parts words, and letters of scripts without spaces are words."""
    text = (text or "").lower()
    if not text.isascii():
        text = SIGNS.sub(" ", LETTERS.sub(r" \g<0> ", text))
    return text.encode("utf-8", "replace").translate(SPLIT).split()


def hashed(text: np.ndarray, n: int, starts: np.ndarray | None = None) -> np.ndarray:
    """Hashes of the runs of n words from `starts` on (0, if None)."""
    starts = np.zeros(1, np.int64) if starts is None else starts
    out = np.full(len(starts), n, np.uint64)
    for j in range(n):
        out = (out ^ text[starts + j].astype(np.uint64)) * words.MIX
        out ^= out >> words.HALF
    return out


def distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of the item to any stretch of the text, and the stretch's first and end word."""
    n = len(text)
    steps = np.arange(n + 1)
    cost, start = np.zeros(n + 1, np.int64), steps.copy()
    for word in item:
        change = cost[:-1] + (text != word)
        drop = cost + 1
        best, origin = drop.copy(), start.copy()
        better = change < best[1:]
        best[1:][better], origin[1:][better] = change[better], start[:-1][better]
        # Words that only the text has: the cheapest way to come from the left.
        slack = best - steps
        lowest = np.minimum.accumulate(slack)
        source = np.maximum.accumulate(np.where(slack == lowest, steps, 0))
        cost, start = lowest + steps, origin[source]
    end = int(np.argmin(cost))
    return int(cost[end]), int(start[end]), end


class Items:
    """Benchmark items: short ones by their words' hash, stretches of the others embedded, by length class and table."""

    def __init__(self, names: list[int | None], texts: list[str | None], seed: int = 5) -> None:
        parts = [(name, split(text)) for name, text in zip(names, texts)]
        parts = [(name, part) for name, part in parts if part]
        # Words are numbered from 1; a word of no item has a negative hash.
        self.place = {word: i + 1 for i, word in enumerate(sorted({w for _, part in parts for w in part}))}
        self.names, self.items = [name for name, _ in parts], [self.sequence(part) for _, part in parts]
        self.edits = [int(EDITS * len(t)) for t in self.items]
        self.pairs = np.unique(np.concatenate([*(self.paired(t) for t in self.items), np.zeros(0, np.int64)]))
        self.seeds = np.random.default_rng(seed).integers(1, 2**63, (WALKS, 4096), dtype=np.uint64) | np.uint64(1)
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        # Stretches by length: (item, first word), and the edits that one of an item's stretches can have.
        cut: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.spare: dict[int, int] = {}
        for i, item in enumerate(self.items):
            n = len(item)
            if n < LEAST_WORDS:
                self.short[n][int(hashed(item, n)[0])].append(i)
                continue
            many = -(-n // STRETCH)
            for j in range(many):
                first, last = j * n // many, (j + 1) * n // many
                cut[last - first].append((i, first))
                self.spare[last - first] = max(self.spare.get(last - first, 0), self.edits[i] // many)
        self.short = {n: dict(own) for n, own in self.short.items()}
        # Per class: (shortest, lengths, sampled steps per table), and its keys with the stretch each comes from.
        self.classes: list[tuple[int, list[int], np.ndarray]] = []
        for length in sorted(cut):
            if not self.classes or length >= self.classes[-1][0] * GROWTH:
                rng = np.random.default_rng([seed, length])
                steps = np.stack([np.sort(rng.choice(max(SAMPLED, int(PACE * length)), SAMPLED, replace=False)) for _ in range(TABLES)])
                self.classes.append((length, [], steps))
            self.classes[-1][1].append(length)
        self.known, self.stretch = [], []
        for c, (_, lengths, _) in enumerate(self.classes):
            own = [(i, first, n) for n in lengths for i, first in cut[n]]
            text = np.concatenate([self.items[i][first : first + n] for i, first, n in own])
            ends = np.cumsum([n for _, _, n in own])
            keys = self.keys(c, text, ends - [n for _, _, n in own], ends).ravel()
            order = np.argsort(keys, kind="stable")
            self.known.append(keys[order])
            self.stretch.append(np.repeat(np.array([x[:2] for x in own], np.int32), TABLES, axis=0)[order])

    def sequence(self, parts: list[bytes]) -> np.ndarray:
        out = np.fromiter(map(self.place.get, parts, repeat(0)), np.int64, len(parts))
        other = np.flatnonzero(out == 0)
        out[other] = -3 - (words.hashes([parts[i] for i in other.tolist()]) >> np.uint64(2)).astype(np.int64)
        return out

    def paired(self, text: np.ndarray) -> np.ndarray:
        """A number per pair of neighbours, -1 where either is of no item."""
        known = (text[:-1] > 0) & (text[1:] > 0)
        return np.where(known, text[:-1] * (len(self.place) + 1) + text[1:], -1)

    def keys(self, c: int, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Table keys (windows x TABLES) of the windows that begin at `start`; their text ends at `end`."""
        shortest, _, steps = self.classes[c]
        out = np.zeros((len(start), TABLES), np.uint64)
        for walk in range(WALKS):
            own = range(walk, TABLES, WALKS)
            written = {int(s): [] for t in own for s in steps[t]}
            for t in own:
                for s in steps[t]:
                    written[int(s)].append(t)
            at = start.copy()
            for step in range(max(written) + 1):
                word = np.where(at < end, text[np.minimum(at, len(text) - 1)], PAD).astype(np.uint64) * words.MIX
                for t in written.get(step, ()):
                    out[:, t] = (out[:, t] ^ word) * words.MIX + np.uint64(step)
                at += ((word ^ (word >> np.uint64(31))) * self.seeds[walk, step % 4096] >> np.uint64(63)).astype(np.int64)
        return out * words.FOLD + np.arange(TABLES, dtype=np.uint64)

    def candidates(self, text: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, window, where the item would begin) of colliding windows. `end` gives, for each word, where its document ends."""
        pair = self.paired(text)
        spot = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        ours = self.pairs[spot] == pair if len(self.pairs) else np.zeros(len(pair), bool)
        before = np.concatenate([[0], np.cumsum(ours), [0]])
        before[-1] = before[-2]
        for n, items in self.short.items():
            windows = np.flatnonzero((start + n <= end) & (text > 0))
            windows = windows[before[windows + n - 1] - before[windows] == n - 1]
            for at, key in zip(windows.tolist(), hashed(text, n, windows).tolist()):
                for item in items.get(key, ()):
                    yield item, at, at
        for c, (_, lengths, _) in enumerate(self.classes):
            able = np.zeros(len(text), bool)
            for n in lengths:
                k = self.spare[n]
                able |= before[np.minimum(start + n + k, end) - 1] - before[start] >= n - 1 - 2 * k
            windows = np.flatnonzero(able)
            known, stretch = self.known[c], self.stretch[c]
            for first in range(0, len(windows), 20_000):
                some = windows[first : first + 20_000]
                keys = self.keys(c, text, some, end[some])
                row, table = np.nonzero(known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys)
                keys = keys[row, table]
                low, high = np.searchsorted(known, keys, "left"), np.searchsorted(known, keys, "right")
                # Each colliding window with every stretch of that key, once.
                many = high - low
                at = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
                hits = np.unique(np.column_stack([stretch[at], np.repeat(some[row], many)]), axis=0)
                for item, ahead, spot in hits.tolist():
                    yield item, spot, spot - ahead

    def find(self, texts: list[np.ndarray]) -> list[list[dict]]:
        """The verified items of each text, the closest stretch of each."""
        found: list[list[dict]] = [[] for _ in texts]
        if not self.items or not sum(map(len, texts)):
            return found
        text = np.concatenate(texts)
        ends = np.cumsum([len(t) for t in texts])
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        spots: dict[tuple[int, int], list[int]] = defaultdict(list)
        for item, window, at in self.candidates(text, np.arange(len(text)), ends[owner]):
            spots[int(owner[window]), item].append(at)
        for (doc, i), starts in sorted(spots.items()):
            item, k = self.items[i], self.edits[i]
            low, high, best = int(ends[doc]) - len(texts[doc]), int(ends[doc]), None
            starts.sort()
            seen = 0
            while seen < len(starts):
                # Windows close to each other are verified together.
                upto = bisect.bisect_right(starts, starts[seen] + len(item))
                near = starts[seen:upto]
                seen = upto
                # The words before a stretch can be longer or shorter by the edits.
                first, last = max(low, near[0] - 2 * k), min(high, max(low, near[-1]) + len(item) + 2 * k)
                stretch = text[first:last]
                if np.isin(item, stretch).sum() < len(item) - k:
                    continue
                gap, begin, end = distance(item, stretch)
                if gap <= k and (best is None or gap < best[0]):
                    best = (gap, first + begin - low, first + end - low)
            if best:
                found[doc].append({
                    "item_id": self.names[i], "distance": best[0], "item_words": len(item), "first_word": best[1], "last_word": best[2],
                })
        return found


def with_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "leaks") -> DataFrame:
    """Add `out`: the benchmark items (item_id, text) that the text holds, with distance and word range (end excluded).

    NULL and empty texts and items without words give no leaks (an empty array). Equal items are each reported; a
    column called `out` is replaced. The items pass by in blocks of about ITEM_WORDS words, one pass over the texts for each block.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    volume = items.agg(F.sum(F.size(F.split("text", "[ \t\n]+")))).first()[0] or 0
    blocks = max(1, -(-volume // ITEM_WORDS))
    columns = []
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        columns.append(_finder(spark, Items([r.item_id for r in part], [r.text for r in part]))(F.col(f"`{text}`")))
    return docs.withColumn(out, F.flatten(F.array(*columns)) if blocks > 1 else columns[0])


def _finder(spark: SparkSession, known: Items):
    shipped = spark.sparkContext.broadcast(cloudpickle.dumps(known))

    @F.pandas_udf(LEAKS)
    @words.tidy
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = cloudpickle.loads(shipped.value)
        for batch in batches:
            found, pending, size = [], [], 0
            for value in batch:
                pending.append(held.sequence(split(value)))
                size += len(value or "")
                if size > CHUNK:
                    found.extend(held.find(pending))
                    pending, size = [], 0
            found.extend(held.find(pending))
            yield pd.Series(found, dtype=object)

    return run


cloudpickle.register_pickle_by_value(sys.modules[__name__])
