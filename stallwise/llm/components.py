"""Connected components of an edge table: each node with the smallest node it reaches.

Alternates the two star operations: every node hands its larger neighbours, then its smaller ones, to the smallest node
it sees. Paths halve each turn, so a chain of n nodes needs about log n turns. Nothing but two counters reaches the
driver; each turn is cut with a checkpoint in the shared folder, so a lost executor repeats one turn only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise.sources import scratch

# Edges that a task of a turn is worth.
EDGES = 10_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of `edges` (a, b); loops, repeats and either direction are allowed.

    Rows with a NULL end are left out; no edges give no rows.
    """
    edges = edges.where("a is not null and b is not null")
    loops = edges.where("a = b").select(F.col("a").alias("node"))
    turned = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    stars = scratch.cut(turned)
    before = _state(stars)
    while before[0]:
        # Turns over few edges write few files: each shuffle's map side has no more tasks than the edges fill.
        parts = 1 + before[0] // EDGES
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(parts)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        large = large.coalesce(parts).distinct().coalesce(parts)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        stars = scratch.cut(small.where("a <> b").coalesce(parts).distinct().coalesce(parts))
        after = _state(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("b").alias("node")).union(loops).distinct()
    labels = stars.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.union(roots.join(labels, "node", "left_anti").select("node", F.col("node").alias("label")))
