"""Class-based bigram language model: exchange clustering, smoothed transitions and emissions.

1. Words are counted over the whole training part. The most frequent (HEAD at most, by a cut in the count that leaves
   no ties behind) get numbers; each text is written once as numbers, with the hashes of its rarer words beside.
2. All numbered words are put in classes by exchange: a word moves to the class that raises the likelihood of the class
   bigrams most. Words lie in blocks, each with the whole lists of their neighbours, made once; a sweep lets every block
   exchange its words against the classes of the last sweep.
3. Rarer and unseen words share one class, in which their own counts, joined by hash, tell them apart.
4. log10 P(text) = sum of log10 P(class | class before) + log10 P(word | class); the end of a text is a class too, and
   stands before its first word.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm import words
from stallwise.sources import scratch

HEAD = 1 << 18
# Parts into which words of one count are dealt by hash.
TIES = 1 << 20
CLASSES = 64
SWEEPS = 6
# Blocks of words, at least, and tokens that a block is worth; a packed row of a block: 2 * word + side, neighbour, times.
BLOCKS = 32
LIST_TOKENS = 1_000_000
LISTED = np.dtype([("word", "<i4"), ("other", "<i4"), ("n", "<i8")])
CHUNK = 4_000_000
# Weight of a class's own frequency in its transitions, and of each word in emissions.
TRANSITION_PRIOR = 20.0
EMISSION_PRIOR = 0.5


def counted(docs: DataFrame) -> DataFrame:
    """(h, c): how often each word occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for texts in words.chunks(batches, CHUNK):
            h, c = np.unique(words.hashes([w for t in texts for w in words.words(t)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"])

    return docs.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int) -> Column:
    """The words that are numbered: all above a count, and of those tied at it an even part by hash that fills the room.

    At most `most` words in expectation, and never more than a few per thousand above that.
    """
    steps = counts.groupBy("c").agg(F.count("*").alias("n")).orderBy(F.desc("c")).limit(most).collect()
    total = 0
    for row in steps:
        if total + row.n > most:
            part = int((most - total) / row.n * TIES)
            return (F.col("c") > row.c) | ((F.col("c") == row.c) & (F.pmod(F.xxhash64("h"), F.lit(TIES)) < part))
        total += row.n
    return F.lit(True)


@dataclass
class Head:
    """Numbered words: 0 is the most frequent. `order` sorts `hashes` for look-ups."""

    hashes: np.ndarray
    counts: np.ndarray

    def __post_init__(self) -> None:
        self.order = np.argsort(self.hashes)
        self.sorted = self.hashes[self.order]

    @property
    def size(self) -> int:
        return len(self.hashes)

    def number(self, h: np.ndarray) -> np.ndarray:
        """Numbers of words; `size` for rarer and unseen ones. `size` + 1 is the end of a text."""
        if not self.size:
            return np.zeros(len(h), np.int64)
        spot = np.minimum(np.searchsorted(self.sorted, h), self.size - 1)
        return np.where(self.sorted[spot] == h, self.order[spot], self.size)


def head_of(counts: DataFrame) -> Head:
    rows = counts.where(frequent(counts, HEAD)).toPandas().sort_values(["c", "h"], ascending=[False, True])
    return Head(rows["h"].to_numpy(np.int64).view(np.uint64), rows["c"].to_numpy(np.int64))


def encoded(docs: DataFrame, head: Head) -> DataFrame:
    """(row, doc_id, held_out, ids, rare): each text as packed numbers without its end, and hashes of its rarer words."""
    shipped = docs.sparkSession.sparkContext.broadcast((head.hashes.tobytes(), head.counts.tobytes()))

    @F.pandas_udf("struct<ids:binary,rare:array<long>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held = Head(*(np.frombuffer(x, t) for x, t in zip(shipped.value, (np.uint64, np.int64))))
        for batch in batches:
            ids, rare = [], []
            for text in batch:
                h = words.hashes(words.words(text or b""))
                own = held.number(h)
                ids.append(own.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes())
                rare.append(h[own == held.size].view(np.int64))
            yield pd.DataFrame({"ids": ids, "rare": rare})

    rows = docs.withColumn("coded", run(F.col("text").cast("binary")))
    return rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "coded.ids", "coded.rare")


def unpack(ids: bytes) -> np.ndarray:
    raw = np.frombuffer(ids, np.uint8).reshape(-1, 3).astype(np.int64)
    return raw[:, 0] | raw[:, 1] << 8 | raw[:, 2] << 16


def running(batch: pa.RecordBatch, end: int) -> Iterator[np.ndarray]:
    """Texts in a row, each led and followed by `end`, in arrays of bounded length."""
    parts, size = [np.array([end])], 0
    for value in batch.column("ids"):
        own = unpack(value.as_py())
        parts += [own, np.array([end])]
        size += len(own)
        if size > 1_000_000:
            yield np.concatenate(parts)
            parts, size = [np.array([end])], 0
    yield np.concatenate(parts)


def pair_counts(texts: DataFrame, left: np.ndarray, right: np.ndarray, width: int, end: int) -> DataFrame:
    """(pair, n): neighbours counted as left[a] * width + right[b]; negative codes on either side are left out."""
    shipped = texts.sparkSession.sparkContext.broadcast((left, right))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = shipped.value
        for batch in batches:
            for stream in running(batch, end):
                a, b = one[stream[:-1]], other[stream[1:]]
                keep = (a >= 0) & (b >= 0)
                pair, n = np.unique(a[keep] * width + b[keep], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(n)], names=["pair", "n"])

    return texts.select("ids").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def gains(table: np.ndarray, before: np.ndarray, after: np.ndarray, at: int) -> np.ndarray:
    """Change of the class bigrams' likelihood when a word moves from class `at` to each class.

    `before` and `after` count the classes of the word's left and right neighbours, itself left out; `table` counts
    class pairs with the word still in `at`.
    """
    ins, outs = table.sum(axis=0), table.sum(axis=1)
    ins[at] -= before.sum()
    outs[at] -= after.sum()
    cross = table.diagonal().copy()
    cross[at] = max(0, cross[at] - before[at] - after[at])
    # The word adds `before` to the column of its class and `after` to the row; where these cross, both meet. Only
    # classes beside which the word stands change anything, and a rare word has few of them.
    left, right = np.flatnonzero(before), np.flatnonzero(after)
    above, beside = table[left], table[:, right]
    above[:, at] -= before[left]
    above[left == at] -= after
    beside[at] -= after[right]
    beside[:, right == at] -= before[:, None]
    above, beside = np.maximum(above, 0), np.maximum(beside, 0)
    column = (xlogx(above + before[left, None]) - xlogx(above)).sum(axis=0)
    line = (xlogx(beside + after[right]) - xlogx(beside)).sum(axis=1)
    meeting = xlogx(cross + before + after) + xlogx(cross) - xlogx(cross + before) - xlogx(cross + after)
    size = xlogx(ins + before.sum()) - xlogx(ins) + xlogx(outs + after.sum()) - xlogx(outs)
    gain = column + line + meeting - size
    return gain - gain[at]


@dataclass
class Lists:
    """Neighbours of a block of words: `other` stood `n` times left (side 0) or right (side 1) of `word`."""

    word: np.ndarray
    side: np.ndarray
    other: np.ndarray
    n: np.ndarray

    @staticmethod
    def of(packed: bytes) -> Lists:
        rows = np.frombuffer(packed, LISTED)
        return Lists(rows["word"] >> 1, rows["word"] & 1, rows["other"], rows["n"])


def neighbour_lists(texts: DataFrame, words_: int, tokens: int) -> DataFrame:
    """(block, rows): for every numbered word all of its neighbours among numbered words and ends, packed by block.

    The end of a text is word number `words_`. A task sends its counts packed, so a block is merged from one row per task
    and chunk; blocks grow in number with the corpus.
    """
    blocks, end = max(BLOCKS, tokens // LIST_TOKENS), words_ + 1
    code = np.arange(words_ + 2)
    code[words_], code[end] = -1, words_
    shipped = texts.sparkSession.sparkContext.broadcast(code)

    @words.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shipped.value
        for batch in batches:
            for stream in running(batch, end):
                coded = held[stream]
                a, b = coded[:-1], coded[1:]
                keep = (a >= 0) & (b >= 0) & ((a < words_) | (b < words_))
                pair, n = np.unique(a[keep] * (words_ + 1) + b[keep], return_counts=True)
                a, b = np.divmod(pair, words_ + 1)
                rows = np.empty(2 * len(pair), LISTED)
                rows["word"], rows["other"], rows["n"] = np.concatenate([a * 2 + 1, b * 2]), np.concatenate([b, a]), np.concatenate([n, n])
                place = (rows["word"] >> 1) % blocks
                order = np.lexsort((rows["other"], rows["word"], place))
                rows, place = rows[order], place[order]
                met, first = np.unique(place, return_index=True)
                parts = np.split(rows, first[1:]) if len(met) else []
                yield pa.RecordBatch.from_pydict({"block": met.astype(np.int64), "rows": [p.tobytes() for p in parts]}, schema=pa.schema([("block", pa.int64()), ("rows", pa.binary())]))

    def merge(held: pd.DataFrame) -> pd.DataFrame:
        rows = np.frombuffer(b"".join(held["rows"]), LISTED)
        rows = rows[np.lexsort((rows["other"], rows["word"]))]
        first = np.flatnonzero(np.concatenate([[True], (rows["word"][1:] != rows["word"][:-1]) | (rows["other"][1:] != rows["other"][:-1])]))
        merged = rows[first].copy()
        merged["n"] = np.add.reduceat(rows["n"], first)
        return pd.DataFrame({"block": held["block"].iloc[:1], "rows": [merged.tobytes()]})

    # Partitions of about one block, as a task holds the rows of its partition at once.
    packed = texts.select("ids").mapInArrow(run, "block long, rows binary").repartition(blocks, "block")
    return packed.groupBy("block").applyInPandas(merge, "block long, rows binary")


def contexts(lists: Lists, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words in order, and the class counts of their left and right neighbours. `classes` ends with that of the end."""
    # A word beside itself says nothing about where it should go; the end stays where it is.
    keep = (lists.word != lists.other) & (lists.word < len(classes) - 1)
    known, row = np.unique(lists.word[keep], return_inverse=True)
    shape = (2, len(known), CLASSES + 1)
    spots = np.ravel_multi_index((lists.side[keep], row, classes[lists.other[keep]]), shape) if len(known) else np.zeros(0, np.int64)
    counts = np.bincount(spots, lists.n[keep], int(np.prod(shape))).reshape(shape)
    return known, counts[0], counts[1]


def exchange(lists: Lists, classes: np.ndarray, table: np.ndarray, half: int | None) -> pd.DataFrame:
    """Move each word of a block in turn to its best class, most frequent first; a later one sees the earlier moves.

    `half`: only words of even (0) or odd (1) number; None: all.
    """
    table, out = table.copy(), []
    for word, before, after in zip(*contexts(lists, classes)):
        if half is not None and word % 2 != half:
            continue
        at = int(classes[word])
        gain = gains(table, before, after, at)
        best = int(np.argmax(gain[:CLASSES]))
        if gain[best] > 1e-9:
            table[:, at] -= before
            table[at, :] -= after
            table[:, best] += before
            table[best, :] += after
            out.append((int(word), best))
    return pd.DataFrame(out, columns=["word", "class"], dtype=np.int64)


def table_of(lists: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Counts of class pairs; bounded by the number of classes."""
    k = CLASSES + 1

    @words.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(k * k, np.int64)
        for batch in batches:
            for packed in batch.column("rows"):
                own = Lists.of(packed.as_py())
                after = own.side == 1
                np.add.at(table, classes[own.word[after]] * k + classes[own.other[after]], own.n[after])
        met = np.flatnonzero(table)
        yield pa.RecordBatch.from_pydict({"cell": met, "n": table[met]})

    found = lists.select("rows").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(k * k)
    table[found["cell"].to_numpy(np.int64)] = found["n"].to_numpy(float)
    return table.reshape(k, k)


def moved(lists: DataFrame, classes: np.ndarray, table: np.ndarray, half: int | None) -> pd.DataFrame:
    """(word, class) of the words that a sweep moves; at most a row per numbered word."""

    @words.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column("rows"):
                moves = exchange(Lists.of(packed.as_py()), classes, table, half)
                yield pa.RecordBatch.from_pydict({"word": moves["word"].to_numpy(), "class": moves["class"].to_numpy()})

    return lists.select("rows").mapInArrow(run, "word long, class long").toPandas()


def cluster(texts: DataFrame, head: Head) -> np.ndarray:
    """The class of every numbered word (and of the end: the last class), all of them exchanged in every pair of sweeps."""
    n, last = head.size, CLASSES
    lists = scratch.cut(neighbour_lists(texts, n, int(head.counts.sum())))
    now = np.append(np.arange(n) % CLASSES, last)
    for sweep in range(SWEEPS):
        moves = moved(lists, now, table_of(lists, now), sweep % 2 if sweep < SWEEPS - 1 else None)
        now[moves["word"].to_numpy(np.int64)] = moves["class"].to_numpy(np.int64)
    return np.concatenate([now[:n], [-1, last]])


@dataclass
class Model:
    """Log10 tables. `classes`: of each number, rarer words (the class after all others but the end) and the end."""

    classes: np.ndarray
    transition: np.ndarray
    emission: np.ndarray
    base: np.ndarray
    known: np.ndarray
    tokens: int
    distinct: int
    rare_floor: float


def fit(texts: DataFrame, head: Head, tokens: int, distinct: int, documents: int) -> Model:
    """`tokens` and `distinct` count the ends of texts as well."""
    rare, end = head.size, head.size + 1
    classes = cluster(texts, head)
    classes[rare], classes[end] = CLASSES + 1, CLASSES
    k = CLASSES + 2
    rows = pair_counts(texts, classes, classes, k, end).toPandas()
    table = np.zeros((k, k))
    table.ravel()[rows["pair"].to_numpy(np.int64)] = rows["n"].to_numpy(float)
    share = (table.sum(axis=0) + 0.5) / (table.sum() + 0.5 * k)
    transition = np.log10((table + TRANSITION_PRIOR * share) / (table.sum(axis=1, keepdims=True) + TRANSITION_PRIOR))
    sizes = np.bincount(classes[: head.size], minlength=k)
    sums = np.bincount(classes[: head.size], head.counts, k)
    own = classes[: head.size]
    emission = np.zeros(head.size + 2)
    emission[: head.size] = np.log10((head.counts + EMISSION_PRIOR) / (sums[own] + EMISSION_PRIOR * sizes[own]))
    rest = tokens - documents - int(head.counts.sum())
    kinds = max(0, distinct - (documents > 0) - head.size)
    norm = np.log10(tokens + 0.5 * (distinct + 1))
    counts = np.concatenate([head.counts, [0, documents]])
    base = np.log10(counts + 0.5) - norm
    base[rare] = -norm
    return Model(classes, transition, emission, base, counts > 0, tokens, distinct, float(np.log10(max(rest, 0) + 0.5 * (kinds + 1))))


def scored(texts: DataFrame, counts: DataFrame, model: Model, end: int) -> DataFrame:
    """Per text: n_tokens, n_known, base_score, score."""
    shipped = texts.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))

    @F.pandas_udf("struct<n:long,known:long,base:double,score:double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held = cloudpickle.loads(shipped.value)
        for batch in batches:
            out = []
            for ids in batch:
                own = np.append(unpack(ids), end)
                c = held.classes[own]
                steps = held.transition[np.append(c[-1], c[:-1]), c].sum() + held.emission[own].sum()
                out.append((len(own), int(held.known[own].sum()), float(held.base[own].sum()), float(steps)))
            yield pd.DataFrame(out, columns=["n", "known", "base", "score"])

    rare = texts.select("row", F.explode("rare").alias("h")).groupBy("row", "h").agg(F.count("*").alias("tf"))
    rare = rare.join(counts, "h", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    rare = rare.groupBy("row").agg(
        F.sum(F.col("tf") * F.log10(F.col("c") + 0.5)).alias("logs"), F.sum("tf").alias("n_rare"), F.sum(F.when(F.col("c") > 0, F.col("tf")).otherwise(0)).alias("rare_known")
    )
    rows = texts.select("row", "doc_id", "held_out", run("ids").alias("s")).join(rare, "row", "left").na.fill(0, ["logs", "n_rare", "rare_known"])
    return rows.select(
        "doc_id", "held_out", F.col("s.n").alias("n_tokens"), (F.col("s.known") + F.col("rare_known")).alias("n_known"), F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("s.base") + F.col("logs")).alias("base_score"),
        (F.col("s.score") + F.col("logs") - F.col("n_rare") * model.rare_floor).alias("score"),
    )


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Per row of (doc_id, text): (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from the rows for which `held_out` is false and scores all. A NULL or empty text is its end alone; with
    nothing to learn from, all counts are 0. Repeated rows count, and are scored, each. An empty table gives no rows.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held_out.alias("held_out"))
    train = docs.where("not held_out")
    counts = scratch.cut(counted(train))
    totals = counts.agg(F.sum("c"), F.count("*")).first()
    documents = train.count()
    tokens, distinct = (totals[0] or 0) + documents, totals[1] + (documents > 0)
    head = head_of(counts)
    texts = scratch.cut(encoded(docs, head))
    model = fit(texts.where("not held_out"), head, tokens, distinct, documents)
    return scored(texts, counts, model, head.size + 1)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
