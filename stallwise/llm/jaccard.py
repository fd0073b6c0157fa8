"""Similarity join of documents on their word shingles by rare-first prefix filtering.

A document's set is its distinct shingles. Two sets of Jaccard similarity t or more share a shingle within the rarest
n - ceil(t n) + 1 of each (its prefix), under any order that all sets share.

1. Equal sets become one class, so copies cost one row.
2. Rarest first means that shingles seen once come before all others. A set that has more of these than its prefix
   leaves room for can't link. Counting only the shingles of a fixed part of the hash range already settles that for
   almost all texts, so that part alone crosses the network, packed 6 bytes a shingle. A shingle that is frequent
   within a task is sent once by that task.
3. The classes left are ordered by true frequency; prefix shingles form lists. Length, positional and suffix filters
   drop pairs before their sets meet; a pair is verified once, on whole sets.
4. Hot lists: first all members are held against the list's most typical set. Members of one component need no more
   checks among each other, so afterwards only those outside the list's main component are paired, with all others.
   That loses no component and never makes all pairs of a group of copies.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallwise.llm import components, words
from stallwise.sources import scratch

RANGE = 1024
WIDTH = 6
# Shingles counted by one task of step 2, and bytes of text that a task of it works on at once.
BUCKET = 1_000_000
CHUNK = 8_000_000
# Bits of the map that tells which sets are still in play. A full map only costs time.
MARK_BITS = 1 << 27
SUFFIX_PARTS = 16


def _pack(values: np.ndarray) -> bytes:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes()


def _unpack(packed: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, WIDTH)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :WIDTH] = raw
    return wide.view("<u8").ravel()


def membership(docs: DataFrame, k: int, text: str = "text") -> DataFrame:
    """`docs` with `digest` (binary, of the set) and `n_shingles`."""

    @F.pandas_udf(T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("n", T.LongType())]))
    @words.tidy
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [words.shingle_set(value or b"", k) for value in batch]
            yield pd.DataFrame({"digest": [words.digest(s) for s in sets], "n": [len(s) for s in sets]})

    found = docs.withColumn("_set", run(F.col(f"`{text}`").cast("binary")))
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], F.col("_set.digest").alias("digest"), F.col("_set.n").alias("n_shingles"))


def _allowed(n: Column, percent: int) -> Column:
    """How many shingles of a set of n may be missing from a partner."""
    return n - F.floor((n * percent + 99) / 100)


def _rare(docs: DataFrame, k: int, percent: int, buckets: int) -> DataFrame:
    """(digest, alone): shingles of each set that no other set has, within the counted part of the hash range."""
    part = np.uint64(min(RANGE, (100 - percent) * 3 * RANGE // 100))

    @words.tidy
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for texts in words.chunks(batches, CHUNK):
            sets, names = [], []
            for text in texts:
                own = words.shingle_set(text, k)
                name = words.digest(own)
                if len(own) and name not in seen:
                    seen.add(name)
                    names.append(name)
                    sets.append(own[(own & np.uint64(RANGE - 1)) < part])
            if not sets:
                continue
            values = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
            distinct, first, count = np.unique(values, return_index=True, return_counts=True)
            single = np.zeros(len(values), bool)
            single[first[count == 1]] = True
            shared = distinct[count > 1]
            values, owner = values[single], owner[single]
            place, shared_place = _bucket(values, buckets), _bucket(shared, buckets)
            order = np.lexsort((owner, place))
            values, owner, place = values[order], owner[order], place[order]
            order = np.argsort(shared_place, kind="stable")
            shared, shared_place = shared[order], shared_place[order]
            # Only buckets that this chunk has something for are visited.
            met = np.union1d(place, shared_place)
            low, high = np.searchsorted(place, met), np.searchsorted(place, met, "right")
            more_low, more_high = np.searchsorted(shared_place, met), np.searchsorted(shared_place, met, "right")
            rows: dict[str, list] = {"bucket": [], "names": [], "sizes": [], "single": [], "shared": []}
            for i, b in enumerate(met.tolist()):
                span, more = slice(low[i], high[i]), shared[more_low[i] : more_high[i]]
                who, sizes = np.unique(owner[span], return_counts=True)
                rows["bucket"].append(b)
                rows["names"].append(b"".join(names[i] for i in who))
                rows["sizes"].append(sizes.astype("<u4").tobytes())
                rows["single"].append(_pack(values[span] >> np.uint64(10)))
                rows["shared"].append(_pack(more >> np.uint64(10)))
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in list(rows)[1:]]]))

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        single, shared = _unpack(list(rows["single"])), _unpack(list(rows["shared"]))
        distinct, where, counts = np.unique(np.concatenate([single, shared, shared]), return_inverse=True, return_counts=True)
        alone = (counts == 1)[where[: len(single)]]
        sizes = np.frombuffer(b"".join(rows["sizes"]), "<u4").astype(np.int64)
        names = np.frombuffer(b"".join(rows["names"]), "<u8").reshape(-1, 2)
        sums = np.concatenate([[0], np.cumsum(alone)])
        ends = np.cumsum(sizes)
        found = sums[ends] - sums[ends - sizes]
        # One packed row for each part of the sets, not one for each set and bucket.
        part = np.where(found > 0, (names[:, 0] % np.uint64(buckets)).astype(np.int64), -1)
        order = np.argsort(part, kind="stable")[np.count_nonzero(part < 0) :]
        met, first = np.unique(part[order], return_index=True)
        cut = np.split(order, first[1:]) if len(met) else []
        return pd.DataFrame({
            "part": met, "names": [names[own].tobytes() for own in cut], "alone": [found[own].astype("<u4").tobytes() for own in cut],
        })

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        names = np.frombuffer(b"".join(rows["names"]), "<u8").reshape(-1, 2)
        alone = np.frombuffer(b"".join(rows["alone"]), "<u4").astype(np.int64)
        order = np.lexsort((names[:, 1], names[:, 0]))
        names, alone = names[order], alone[order]
        first = np.flatnonzero(np.concatenate([[True], (names[1:] != names[:-1]).any(axis=1)]))
        return pd.DataFrame({"digest": [x.tobytes() for x in names[first]], "alone": np.add.reduceat(alone, first)})

    packed = docs.select("text").mapInArrow(gather, "bucket int, names binary, sizes binary, single binary, shared binary")
    counted = packed.groupBy("bucket").applyInPandas(count, "part int, names binary, alone binary")
    return counted.groupBy("part").applyInPandas(total, "digest binary, alone long")


def _bucket(values: np.ndarray, buckets: int) -> np.ndarray:
    return ((values >> np.uint64(44)) % np.uint64(buckets)).astype(np.int64)


def _sets(docs: DataFrame, k: int, alive: DataFrame) -> DataFrame:
    """(node, n, elems): the packed sets of the classes in play, each once."""
    spark = docs.sparkSession
    # A bitmap of fixed size over the digests' first bits; the exact join below drops what it lets through.
    marks = np.zeros(MARK_BITS // 8, np.uint8)
    spots = alive.select(F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long"), F.lit(MARK_BITS)).alias("spot"))
    found = spots.groupBy((F.col("spot") / 8).cast("int").alias("cell")).agg(
        F.bit_or(F.expr("shiftleft(1, cast(spot % 8 as int))")).alias("bits")
    ).toPandas()
    marks[found["cell"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).astype(np.uint8)
    shipped = spark.sparkContext.broadcast(marks.tobytes())

    @words.tidy
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked = np.frombuffer(shipped.value, np.uint8)
        seen: set[bytes] = set()
        for texts in words.chunks(batches, CHUNK):
            names, sets = [], []
            for text in texts:
                own = words.shingle_set(text, k)
                name = words.digest(own)
                spot = int.from_bytes(name[:4], "big") % MARK_BITS
                if len(own) and marked[spot >> 3] >> (spot & 7) & 1 and name not in seen:
                    seen.add(name)
                    names.append(name)
                    sets.append(own.tobytes())
            if names:
                yield pa.RecordBatch.from_pydict({"digest": names, "elems": sets}, schema=pa.schema([("digest", pa.binary()), ("elems", pa.binary())]))

    rows = docs.select("text").mapInArrow(gather, "digest binary, elems binary")
    rows = rows.groupBy("digest").agg(F.first("elems").alias("elems"))
    return rows.join(alive, "digest").select("node", F.col("n_shingles").alias("n"), "elems")


def _elements(sets: DataFrame) -> DataFrame:
    @words.tidy
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, elems = batch.column("node").to_numpy(), batch.column("elems").to_pylist()
            for start in range(0, len(nodes), 500):
                parts = [np.frombuffer(e, np.int64) for e in elems[start : start + 500]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(nodes[start : start + 500], [len(p) for p in parts])), pa.array(np.concatenate(parts))],
                    names=["node", "h"],
                )

    return sets.select("node", "elems").mapInArrow(spread, "node long, h long")


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """(h, node, n, alone, at): the prefix shingles that some other set has too, with their place in the set's order."""
    elements = _elements(sets)
    frequency = elements.groupBy("h").agg(F.count("*").alias("df")).where("df > 1")
    shared = elements.join(frequency, "h")
    found = shared.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("common"))
    found = found.join(sets.select("node", "n"), "node").withColumn("alone", F.col("n") - F.size("common"))
    room = (_allowed(F.col("n"), percent) + 1 - F.col("alone")).cast("int")
    found = found.where(room > 0).select("node", "n", "alone", F.posexplode(F.slice("common", F.lit(1), room)))
    return found.select(F.col("col.h").alias("h"), "node", "n", "alone", (F.col("alone") + F.col("pos")).alias("at"))


@F.pandas_udf(T.LongType())
def overlap(left: pd.Series, right: pd.Series, least: pd.Series) -> pd.Series:
    """Size of the intersection, or -1 where the suffix filter already rules `least` out."""
    out = []
    for a, b, o in zip(left, right, least):
        x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
        # Sorted sets fall into the same ranges of hashes; within one, they share at most the smaller count.
        cuts = np.arange(1, SUFFIX_PARTS, dtype=np.uint64) << np.uint64(60)
        sizes = [np.diff(np.searchsorted(s, cuts), prepend=0, append=len(s)) for s in (x, y)]
        if np.minimum(*sizes).sum() < o:
            out.append(-1)
        else:
            out.append(len(np.intersect1d(x, y, assume_unique=True)))
    return pd.Series(out, dtype="int64")


def _needed(n: str, m: str, percent: int) -> Column:
    return F.floor(((F.col(n) + F.col(m)) * percent + 99 + percent) / (100 + percent))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) for distinct pairs of nodes."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("an"), F.col("elems").alias("ae"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("bn"), F.col("elems").alias("be"))
    least = _needed("an", "bn", percent)
    both = pairs.join(left, "a").join(right, "b")
    return both.select("a", "b", (overlap("ae", "be", least) >= least).alias("linked"))


def _lists(postings: DataFrame, links: DataFrame | None) -> DataFrame:
    """Postings with `label` (component so far) and `main` (the list's largest), of lists of two components or more."""
    if links is None:
        labelled = postings.withColumn("label", F.col("node"))
    else:
        labels = components.connected(links.select("a", "b"))
        labelled = postings.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    counts = labelled.groupBy("h", "label").agg(F.count("*").alias("c"))
    main = counts.groupBy("h").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.count("*").alias("kinds"))
    return labelled.join(main.where("kinds > 1").drop("kinds"), "h")


def _fits(percent: int) -> Column:
    """Length and positional filters for postings x and y of one shingle, taken as the first that they share."""
    least = _needed("x.n", "y.n", percent)
    rest = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    short, long = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
    return (short * 100 >= long * percent) & (rest >= least)


def _star(lists: DataFrame, percent: int, outside: bool) -> DataFrame:
    """(a, b): every member of a list with the list's most typical set, that of the fewest shingles of its own.

    `outside`: the most typical one among those outside the list's main component.
    """
    pivots = lists.where("label <> main") if outside else lists
    fields = ("node", "label", "n", "at")
    pivots = pivots.groupBy("h").agg(F.min_by(F.struct(*fields), F.struct("alone", "node")).alias("p"))
    pivots = pivots.select("h", *[F.col(f"p.{f}").alias(f) for f in fields])
    joined = lists.alias("x").join(pivots.alias("y"), F.col("x.h") == F.col("y.h"))
    joined = joined.where((F.col("x.label") != F.col("y.label")) & _fits(percent))
    return joined.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()


def _rest(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): members outside a list's main component with all members of other components."""
    outside = lists.where("label <> main").alias("x")
    joined = outside.join(lists.alias("y"), F.col("x.h") == F.col("y.h"))
    once = (F.col("y.label") == F.col("y.main")) | (F.col("x.node") > F.col("y.node"))
    joined = joined.where((F.col("x.label") != F.col("y.label")) & once & _fits(percent))
    return joined.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()


def links(docs: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(a, b): links that connect the classes (digest, node, n_shingles) of similar sets into their components."""
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    counted = _rare(docs, k, percent, int(max(16, total * min(1.0, (100 - percent) * 0.03) // BUCKET)))
    alive = classes.join(counted, "digest", "left").where(F.coalesce("alone", F.lit(0)) <= _allowed(F.col("n_shingles"), percent))
    alive = scratch.cut(alive.select("digest", "node", "n_shingles"))
    sets = scratch.cut(_sets(docs, k, alive))
    postings = scratch.cut(_postings(sets, percent))
    tried = scratch.cut(_verified(_star(_lists(postings, None), percent, outside=False), sets, percent))
    for make in (lambda lists: _star(lists, percent, outside=True), lambda lists: _rest(lists, percent)):
        lists = _lists(postings, tried.where("linked"))
        pairs = make(lists).join(tried, ["a", "b"], "left_anti")
        tried = scratch.cut(tried.union(_verified(pairs, sets, percent)))
    return tried.where("linked").select("a", "b")


def similar(docs: DataFrame, k: int = 3, percent: int = 90) -> DataFrame:
    """Per row of (doc_id, text): (doc_id, n_shingles, component_id).

    Two documents link when 100 * |intersection| >= percent * |union| of their sets of k-word shingles; a component is
    all that links reach, named by its smallest doc_id. A text with fewer than k words is one shingle; a text without
    words, or NULL, has none, links with nothing and is its own component. Repeated rows stay, in one component. A
    NULL doc_id never names a component unless it has no other; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    members = scratch.cut(membership(docs, k).drop("text"))
    classes = members.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("smallest"), F.first("n_shingles").alias("n_shingles"))
    classes = scratch.cut(classes.withColumn("node", F.xxhash64("digest")))
    labels = components.connected(links(docs, classes, k, percent))
    named = classes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    names = named.groupBy("label").agg(F.min("smallest").alias("component_id"))
    named = named.join(names, "label").select("digest", "component_id")
    found = members.join(named, "digest", "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
