"""Approximate nearest neighbours by cosine over robust-pruned directed graphs, one graph per shard.

Equal vectors are one node that carries its smallest ids, enough for any answer, so a vector that a third of all rows
share is one node. Shards hold about SHARD nodes, dealt by a hash of the vector. In a shard, nodes enter in growing
batches: a greedy beam search on the graph so far proposes neighbours, and relaxed distance pruning keeps an edge only
if no kept neighbour is closer by the factor ALPHA; edges are then given back and pruned again. A query block searches
each shard's graph with a beam; the best nodes get their exact cosine in double precision, and a window keeps the
nearest over all shards.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stallwise.sources import scratch

SHARD = 4096
DEGREE = 28
BEAM = 56
ALPHA = 1.2
SEARCH_BEAM = 96
BATCH = 256
# Queries that search a shard together.
BLOCK = 4096


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query the `beam` best nodes met, best first, and their cosines; -1 and -inf fill up."""
    rows = np.arange(len(q))
    ids = np.full((len(q), beam), -1)
    sims = np.full((len(q), beam), -np.inf, np.float32)
    done = np.ones((len(q), beam), bool)
    ids[:, 0], sims[:, 0], done[:, 0] = entry, q @ x[entry], False
    while True:
        live = np.flatnonzero(~done.all(axis=1))
        if not len(live):
            return ids, sims
        at = np.argmin(done[live], axis=1)
        done[live, at] = True
        near = graph[ids[live, at]]
        known = (near[:, :, None] == ids[live][:, None, :]).any(axis=2) | (near < 0)
        sim = np.einsum("bd,brd->br", q[live], x[near])
        sim[known] = -np.inf
        all_sims = np.concatenate([sims[live], sim], axis=1)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        pick = rows[: len(live), None]
        sims[live] = all_sims[pick, order]
        ids[live] = np.where(sims[live] > -np.inf, np.concatenate([ids[live], near], axis=1)[pick, order], -1)
        done[live] = np.concatenate([done[live], known], axis=1)[pick, order]


def prune(x: np.ndarray, own: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Up to DEGREE diverse neighbours of each node in `own` out of its candidates (-1: none), nearest first."""
    vectors = x[found]
    gap = 2 - 2 * np.einsum("bd,bcd->bc", x[own], vectors)
    alive = (found >= 0) & (found != own[:, None])
    # A candidate listed twice counts once.
    order = np.argsort(found, axis=1, kind="stable")
    same = np.zeros_like(alive)
    sorted_ids = np.take_along_axis(found, order, axis=1)
    np.put_along_axis(same, order[:, 1:], sorted_ids[:, 1:] == sorted_ids[:, :-1], axis=1)
    alive &= ~same
    out = np.full((len(own), DEGREE), -1)
    rows = np.arange(len(own))
    for slot in range(DEGREE):
        best = np.argmin(np.where(alive, gap, np.inf), axis=1)
        has = alive[rows, best]
        if not has.any():
            break
        out[has, slot] = found[rows, best][has]
        between = 2 - 2 * np.einsum("bd,bcd->bc", vectors[rows, best], vectors)
        alive &= (ALPHA * between > gap) & has[:, None]
        alive[rows, best] = False
    return out


def build(x: np.ndarray, seed: int = 11) -> tuple[np.ndarray, int]:
    """Neighbours of each unit vector, and the entry node: the one nearest to the mean."""
    n = len(x)
    graph = np.full((n, DEGREE), -1)
    entry = int(np.argmax(x @ x.mean(axis=0)))
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    at = 1
    while at < n:
        own = order[at : at + min(BATCH, max(1, at))]
        at += len(own)
        found, _ = beam_search(x, graph, entry, x[own], BEAM)
        graph[own] = prune(x, own, found)
        source, target = np.repeat(own, DEGREE), graph[own].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        given = np.full((len(nodes), count.max()), -1)
        given[np.repeat(np.arange(len(nodes)), count), np.arange(len(target)) - np.repeat(first, count)] = source
        graph[nodes] = prune(x, nodes, np.concatenate([graph[nodes], given], axis=1))
    return graph, entry


def unit(rows: pd.Series) -> np.ndarray:
    x = np.stack(rows.to_numpy()).astype(np.float64)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) without vectors that are NULL, empty, zero or hold NULL or non-finite parts."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v) < float("inf")) & ~F.isnan(v))
    moved = F.exists("embedding", lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.where((F.size("embedding") > 0) & F.coalesce(finite, F.lit(False)) & F.coalesce(moved, F.lit(False)))


def nodes(vectors: DataFrame, most: int) -> DataFrame:
    """(dim, embedding, ids): each distinct vector with its `most` smallest ids. NULL ids take no part."""
    rows = vectors.where("vec_id is not null").groupBy("embedding", "vec_id").agg(F.count("*").alias("n"))
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id")))
    return ranked.where(F.col("r") <= most).groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.size("embedding").alias("dim"), "embedding", "ids"
    )


def index(found: DataFrame, shards: int) -> DataFrame:
    """(dim, shard, at, embedding, ids, links, entry): every node in the graph of its shard."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("first", ignore_index=True)
        graph, entry = build(unit(rows["embedding"]))
        rows["at"] = np.arange(len(rows), dtype=np.int32)
        rows["links"] = [row[row >= 0].astype(np.int32) for row in graph]
        rows["entry"] = rows["at"] == entry
        return rows.drop(columns="first")

    dealt = found.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)).cast("int")).withColumn("first", F.col("ids")[0])
    schema = "dim int, embedding array<double>, ids array<long>, shard int, at int, links array<int>, entry boolean"
    # Small partitions merged at run time would put several shards into one task.
    return dealt.repartition(4 * shards, "dim", "shard").groupBy("dim", "shard").applyInPandas(run, schema)


def search(graphs: DataFrame, queries: DataFrame, shards: int, k: int, blocks: int = 1) -> DataFrame:
    """(query_id, rank, vec_id, score) for queries (vec_id, embedding): the k nearest found, without the query's own id."""

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "query", "vec_id", "score"]
        if left.empty or right.empty:
            return pd.DataFrame(columns=columns).astype({"query_id": "int64", "query": "int64", "vec_id": "int64", "score": "float64"})
        left = left.sort_values("at", ignore_index=True)
        exact = np.stack(left["embedding"].to_numpy()).astype(np.float64)
        length = np.linalg.norm(exact, axis=1)
        x = (exact / length[:, None]).astype(np.float32)
        graph = np.full((len(left), DEGREE), -1)
        for i, links in enumerate(left["links"]):
            graph[i, : len(links)] = links
        entry = int(np.argmax(left["entry"].to_numpy()))
        owners = left["ids"].to_numpy()
        out = []
        for start in range(0, len(right), BATCH):
            part = right.iloc[start : start + BATCH]
            ids, _ = beam_search(x, graph, entry, unit(part["embedding"]), SEARCH_BEAM)
            q = np.stack(part["embedding"].to_numpy()).astype(np.float64)
            for j, (own, key) in enumerate(zip(part["vec_id"], part["query"])):
                # One node more than asked for: the query's own may be among them.
                met = ids[j][ids[j] >= 0]
                cosine = exact[met] @ q[j] / (length[met] * np.linalg.norm(q[j]))
                best = np.argsort(-cosine, kind="stable")
                floor = cosine[best[min(k, len(best) - 1)]]
                for b in best[: k + 1 + int((cosine == floor).sum())]:
                    out.extend((own, key, v, cosine[b]) for v in owners[met[b]] if v != own)
        return pd.DataFrame(out, columns=columns)

    block = F.pmod(F.xxhash64("vec_id", "query"), F.lit(blocks)).cast("int").alias("block")
    asked = queries.withColumn("query", F.xxhash64("embedding")).select("*", F.size("embedding").alias("dim"), block)
    asked = asked.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    held = graphs.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    keys = ("dim", "shard", "block")
    met = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(run, "query_id long, query long, vec_id long, score double")
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """The k nearest by cosine of each vector whose id is divisible by `every`, among all rows but its own id.

    Vectors that are NULL, zero or hold NULL or non-finite parts, and rows without an id, take no part; vectors of
    different lengths never meet. Rows that repeat id and vector count once; an id with several vectors is several
    queries. Equal scores go by the smaller id; fewer candidates give fewer rows, an empty table none.
    """
    rows = usable(vectors)
    found = scratch.cut(nodes(rows, k + 1))
    shards = max(1, -(-found.count() // SHARD))
    graphs = scratch.cut(index(found, shards))
    queries = rows.where(F.col("vec_id") % every == 0).distinct()
    blocks = max(1, -(-queries.count() // BLOCK))
    return search(graphs, queries, shards, k, blocks)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
