"""Shards of near-equal bytes by Karmarkar-Karp differencing over indivisible groups of equal texts.

The groups are the documents with one text. A group above 1/BUNDLES of all bytes is an item of its own, so there are
fewer than BUNDLES of these; all others are gathered by their hash into BUNDLES bundles of whole groups. Differencing
runs over these items, at most 2 * BUNDLES whatever the input, and each document then looks up its item. A group that
holds a third of all rows is one item, and no task ever sees its rows together: sizes are pre-aggregated by group
before the shuffle, and slots are numbered per (shard, slice of the ids).
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUNDLES = 16_384
# Rows of a shard that are numbered in one window.
SLICE_ROWS = 20_000


def difference(sizes: list[int], shards: int) -> list[int]:
    """The shard of each item. The two partial partitions of largest spread are combined again and again, the fullest
    part of one with the emptiest of the other; ties go to the earlier item."""
    if not sizes:
        return []
    # A partial partition: (-spread, order, sums in descending order, one list of nodes per sum).
    heap = [(-size, i, [size] + [0] * (shards - 1), [[i]] + [[] for _ in range(shards - 1)]) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    order = len(sizes)
    while len(heap) > 1:
        _, _, sums, parts = heapq.heappop(heap)
        _, _, others, more = heapq.heappop(heap)
        joined = [(a + b, i) for i, (a, b) in enumerate(zip(sums, reversed(others)))]
        joined.sort(key=lambda x: -x[0])
        # Nested lists keep a combination's cost at the number of shards, not of items.
        merged = [[parts[i], more[shards - 1 - i]] for _, i in joined]
        totals = [total for total, _ in joined]
        heapq.heappush(heap, (totals[-1] - totals[0], order, totals, merged))
        order += 1
    found = [0] * len(sizes)
    for shard, nested in enumerate(heap[0][3]):
        stack = [nested]
        while stack:
            node = stack.pop()
            if isinstance(node, list):
                stack.extend(node)
            else:
                found[node] = shard
    return found


def balanced(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Per row of (doc_id, text): (doc_id, size, text_crc32, shard, slot).

    Size is the UTF-8 bytes of the text plus 1. A NULL text has size 1 and the CRC of no bytes; it is in one group
    with the empty text. NULL and repeated ids are rows like others. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("group"),
    )
    groups = rows.groupBy("group").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    groups = groups.withColumn("bundle", F.pmod(F.xxhash64("group"), F.lit(BUNDLES)).cast("int"))
    whole = groups.agg(F.sum("size"), F.sum("n")).first()
    total, count = whole[0] or 0, whole[1] or 0
    single = F.col("size") > total // BUNDLES
    items = groups.groupBy("bundle", F.when(single, F.col("group")).alias("group")).agg(F.sum("size").alias("size"))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        item = pd.concat([pd.DataFrame({"bundle": [], "group": [], "size": []}), *batches])
        item["key"] = [b"" if g is None else bytes(g) for g in item["group"]]
        item = item.sort_values(["size", "bundle", "key"], ascending=[False, True, True])
        item["shard"] = difference([int(x) for x in item["size"]], shards)
        yield item[["bundle", "group", "shard"]].astype({"bundle": "int32", "shard": "int32"})

    placed = items.repartition(1).mapInPandas(assign, "bundle int, group binary, shard int")
    # At most 2 * BUNDLES rows, written once because two joins read them.
    placed = spark.createDataFrame(placed.toPandas(), "bundle int, group binary, shard int")
    heavy = placed.where("group is not null").select("group", F.col("shard").alias("own"))
    light = placed.where("group is null").select("bundle", F.col("shard").alias("shared"))
    rows = (
        rows.withColumn("bundle", F.pmod(F.xxhash64("group"), F.lit(BUNDLES)).cast("int"))
        .join(F.broadcast(heavy), "group", "left").join(F.broadcast(light), "bundle", "left")
        .withColumn("shard", F.coalesce("own", "shared"))
        .select("doc_id", "size", "text_crc32", "shard")
    )
    return with_slots(rows, count)


def with_slots(rows: DataFrame, count: int) -> DataFrame:
    """Number the rows of each shard from 0 without a gap: first inside slices of it, then with the slice's offset."""
    slices = max(1, count // SLICE_ROWS)
    cut = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(slices)).cast("int"))
    inside = Window.partitionBy("shard", "slice").orderBy("doc_id", "size", "text_crc32")
    numbered = cut.withColumn("inner", F.row_number().over(inside) - 1)
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy("shard", "slice").agg(F.count("*").alias("n"))
    offsets = counts.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return numbered.join(offsets, ["shard", "slice"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("inner")).cast("long").alias("slot")
    )


cloudpickle.register_pickle_by_value(sys.modules[__name__])
