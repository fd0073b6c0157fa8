"""Prefix tries of conversations by fixed-length block hashing.

Every conversation is cut into blocks of BLOCK turns. A block's digest stands for all turns up to its end (the running
XOR of 128-bit hashes of place, role and text), so conversations are grouped block by block: those with equal digests
are one block group, with a count and its smallest conversation. Only that one's turns are looked at from there on, so
copies cost one row a block. Where a group's conversations all go on with the same whole block, its turns are one chain
of nodes with the same members. Where siblings diverge, and only there, the turns inside the sibling blocks are grouped
again, turn by turn, which finds the place at which they part.

Sums over subtrees use pointer doubling: a node adds what it has gathered to its 2^k-th ancestor in round k, so a trie of
depth d takes log2(d) rounds, whatever its shape. Rounds are cut with checkpoints in the shared folder.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stallwise.llm import words
from stallwise.sources import scratch

# Turns of a block.
BLOCK = 4
# Conversation ids whose upper bits are equal are listed together: at most 2^SPAN in a list.
SPAN = 12
WORD = r"[^\x20\x09-\x0D]+"


def _hash(names: str, *parts: str) -> list[Column]:
    """128 bits of the parts, as two numbers."""
    return [F.xxhash64(F.lit(name), *parts).alias(name) for name in names]


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, x, y, words): turns numbered from 1 by turn (NULL first), then role and text.

    x and y are 128 bits of role and text, words the text's number of words. A NULL role or text is an empty one.
    Repeated rows are turns of their own. Rows without a conv_id belong to no conversation and are left out. Cut here,
    so that texts are shuffled once.
    """
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text")]
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = rows.select(
        "conv_id", F.row_number().over(order).alias("place"), *_hash("xy", "role", "text"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"),
    )
    return scratch.cut(numbered)


def shared_starts(own: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations rebuilt to share starts: the first h turns are those of conversation c - c % group.

    h is the unsigned CRC-32 of the id written as text, modulo `most`; the conversation's own turns after its first h
    follow. `own` and the result are as `turns` gives them; a conversation left without turns has one row with place 0.
    """
    h = words.bucket_of_id("conv_id", most)
    ids = own.groupBy("conv_id").agg(F.max("place").alias("n")).select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("first"))
    # A start of at most `most` turns goes to at most `group` conversations.
    starts = own.where(F.col("place") < most).withColumnRenamed("conv_id", "first")
    first = ids.where("h > 0").join(starts, "first").where("place <= h").select(own.columns)
    later = own.where(F.col("place") > h)
    size = ids.join(own.groupBy(F.col("conv_id").alias("first")).agg(F.max("place").alias("n_first")), "first", "left")
    shift = size.select("conv_id", F.least("h", F.coalesce("n_first", F.lit(0))).cast("int").alias("kept"), "h", "n")
    later = later.join(shift.select("conv_id", "kept", "h"), "conv_id").select(
        "conv_id", (F.col("place") - F.col("h") + F.col("kept")).cast("int").alias("place"), *own.columns[2:]
    )
    none = [F.lit(0).cast("long").alias(c) for c in own.columns[2:]]
    empty = shift.where("kept = 0 and n <= h").select("conv_id", F.lit(0).alias("place"), *none)
    return first.unionByName(later).unionByName(empty)


def marked(rebuilt: DataFrame) -> DataFrame:
    """Per turn: the digest (a, b) of all turns up to it, that of the turn before (a0, b0), its words, and whether it is last.

    Place 0 stands for the root, whose digest is (0, 0).
    """
    # What stands at which place: the running XOR then tells sequences apart, not only sets.
    rows = rebuilt.select("conv_id", "place", "words", *[F.when(F.col("place") > 0, x).otherwise(0).alias(c) for c, x in zip("xy", _hash("xy", "place", "x", "y"))])
    order = Window.partitionBy("conv_id").orderBy("place")
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select("*", F.bit_xor("x").over(run).alias("a"), F.bit_xor("y").over(run).alias("b"), F.lead("place").over(order).isNull().alias("last"))
    return rows.select("conv_id", "place", "words", "last", "a", "b", F.expr("a ^ x").alias("a0"), F.expr("b ^ y").alias("b0"))


def nodes(turn_rows: DataFrame) -> DataFrame:
    """(depth, a, b, a0, b0, conv_id, n_convs, words) of each distinct start of the conversations in `marked` rows.

    conv_id is the smallest member, n_convs the number of members, words those of the start's last turn.
    """
    block = F.floor((F.col("place") - 1) / BLOCK).cast("int")
    real = turn_rows.where("place > 0").withColumn("k", block)
    ends = real.where(F.col("last") | (F.col("place") % BLOCK == 0))
    # The digest at the block's start comes from its first turn, which may be the row itself.
    order = Window.partitionBy("conv_id").orderBy("place")
    ends = ends.select(
        "conv_id", "k", F.col("place").alias("until"), "a", "b",
        F.coalesce(F.lag("a").over(order), F.lit(0)).alias("from_a"), F.coalesce(F.lag("b").over(order), F.lit(0)).alias("from_b"),
    )
    groups = ends.groupBy("k", "until", "a", "b", "from_a", "from_b").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    groups = scratch.cut(groups)
    # A block without siblings is found by counting, not by a join on what may be very many blocks' start.
    only = groups.groupBy("k", "from_a", "from_b").agg(F.count("*").alias("n_siblings"), F.min("conv_id").alias("conv_id"))
    only = only.where("n_siblings = 1").select("conv_id", "k", F.lit(False).alias("parts"))
    groups = groups.join(only, ["conv_id", "k"], "left").select("conv_id", "k", "n", F.coalesce("parts", F.lit(True)).alias("diverges"))
    inside = real.join(groups, ["conv_id", "k"])
    columns = ["place", "a", "b", "a0", "b0"]
    alone = inside.where("not diverges").select(*columns, "conv_id", F.col("n").alias("n_convs"), "words")
    parted = inside.where("diverges").groupBy(columns).agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n_convs"), F.first("words").alias("words"))
    return alone.unionByName(parted).withColumnRenamed("place", "depth")


def ends_of(turn_rows: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): SHA-256 of the ids of the conversations that end at a node, ascending, comma-joined.

    Ids are first listed by ranges of 2^SPAN, so that a node at which very many conversations end is one short row per
    range; a task then reads the lists in order and feeds them to the hash one by one.
    """
    span = F.shiftright("conv_id", SPAN)
    lists = turn_rows.where("last").groupBy("place", "a", "b", span.alias("span")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids")
    )
    keys = ["place", "a", "b"]
    ordered = lists.repartition(*keys).sortWithinPartitions(*keys, "span")

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, hashlib.sha256(), []
        for batch in batches:
            for *own, ids in zip(*(column.to_pylist() for column in batch.columns)):
                if own == node:
                    digest.update(b",")
                else:
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256()
                digest.update(ids.encode())
            yield packed(done)
            done = []
        yield packed([(*node, digest.hexdigest())] if node else [])

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [()] * 4
        types = (pa.int32(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, types)], ["depth", "a", "b", "ends_sha256"])

    return ordered.select(*keys, "ids").mapInArrow(feed, "depth int, a long, b long, ends_sha256 string")


def below(rows: DataFrame, depth: int, *names: str) -> DataFrame:
    """(id, names...): sums of the named columns of `rows` (id, up, depth, names...) over each node and all under it.

    An id is (conv_id, depth), `up` the parent's id, NULL at the root; `depth` is the greatest depth. What points at the
    root has nowhere to go from there and takes no part in the join, whose largest key it would be.
    """
    now = rows.select("id", "up", *names)
    jump = 1
    while jump <= depth:
        given = now.where("up is not null").groupBy(F.col("up").alias("id")).agg(*[F.sum(n).alias(f"more_{n}") for n in names])
        after = now.join(given, "id", "left").select("id", "up", *[(F.col(n) + F.coalesce(f"more_{n}", F.lit(0))).alias(n) for n in names])
        jump *= 2
        if jump <= depth:
            above = now.select(F.col("id").alias("up"), F.col("up").alias("far"))
            moved = after.where("up.depth > 0").join(above, "up").select("id", F.col("far").alias("up"), *names)
            still = after.where("up is null or up.depth = 0").select("id", F.lit(None).cast(now.schema["up"].dataType).alias("up"), *names)
            after = moved.union(still)
        now = scratch.cut(after)
    return now.select("id", *names)


def trie(rebuilt: DataFrame) -> DataFrame:
    """One row per node of the trie of conversations, as `turns` gives them: the starts that they share.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256). conv_id is the smallest
    member; n_leaves the childless nodes of the subtree; saved_tokens the words of last turns, times members but one,
    over the subtree. No conversations give no rows.
    """
    turn_rows = scratch.cut(marked(rebuilt))
    inner = nodes(turn_rows)
    zero = F.lit(0).cast("long")
    root = turn_rows.agg(F.min("conv_id").alias("conv_id"), F.count_distinct("conv_id").alias("n_convs")).where("n_convs > 0").select(
        F.lit(0).alias("depth"), zero.alias("a"), zero.alias("b"), F.lit(None).cast("long").alias("a0"), F.lit(None).cast("long").alias("b0"),
        "conv_id", "n_convs", zero.alias("words"),
    )
    every = scratch.cut(inner.unionByName(root))
    # A node's parent stands one turn higher; its number of children comes with it.
    children = every.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("a0").alias("a"), F.col("b0").alias("b")).agg(F.count("*").alias("n_children"))
    rows = every.join(children, ["depth", "a", "b"], "left").join(ends_of(turn_rows), ["depth", "a", "b"], "left")
    own = rows.select(
        "depth", "a", "b", "a0", "b0", "conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"), ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"),
    )
    above = every.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("a0"), F.col("b").alias("b0"), F.col("conv_id").alias("parent_conv_id"))
    # The first turns' parent is the root, whose smallest member is that of all.
    first = every.where("depth = 0").agg(F.min("conv_id")).scalar()
    deeper = own.where("depth > 1").join(above, ["depth", "a0", "b0"]).select(*own.columns, "parent_conv_id")
    top = own.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, first))
    own = scratch.cut(deeper.unionByName(top))
    # The smallest member and the depth name a node.
    name = F.struct("conv_id", "depth")
    up = F.when(F.col("depth") > 0, F.struct(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")))
    depth = own.agg(F.max("depth")).first()[0] or 0
    sums = below(
        own.select(name.alias("id"), up.alias("up"), (F.col("n_children") == 0).cast("long").alias("n_leaves"), F.col("own_saved").alias("saved_tokens")),
        depth, "n_leaves", "saved_tokens",
    )
    found = own.select(name.alias("id"), "parent_conv_id", "n_convs", "n_children", "ends_sha256").join(sums, "id")
    return found.select(
        "id.conv_id", F.col("id.depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
