"""Prefix tries against a brute-force trie over whole starts, and against the SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stallwise.llm import tries

DDL = "conv_id long, turn long, role string, text string"


def own_turns(rows):
    held = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            held[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {conv: [x[2:] for x in sorted(own)] for conv, own in held.items()}


def rebuilt(own):
    out = {}
    for conv, mine in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        first = abs(conv) // 20 * 20 * (1 if conv > 0 else -1)
        out[conv] = own.get(first, [])[:h] + mine[h:]
    return out


def brute(conversations):
    members, ends = defaultdict(set), defaultdict(list)
    for conv, own in conversations.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].add(conv)
        ends[tuple(own)].append(conv)
    rows = []
    for start, own in members.items():
        under = [s for s in members if s[: len(start)] == start]
        childless = [s for s in under if not any(len(t) == len(s) + 1 and t[: len(s)] == s for t in under)]
        saved = sum((len(members[s]) - 1) * len(re.findall(rb"[^\x20\x09-\x0D]+", s[-1][1].encode())) for s in under if s)
        digest = hashlib.sha256(",".join(map(str, sorted(ends[start]))).encode()).hexdigest()
        up = min(members[start[:-1]]) if start else None
        rows.append((min(own), len(start), up, len(own), sum(len(s) == len(start) + 1 for s in under), len(childless), saved, digest))
    return sorted(rows, key=str)


def shown(df):
    assert df.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, df.collect()), key=str)


def trie(conversations, share=True):
    own = tries.turns(conversations)
    return tries.trie(tries.shared_starts(own) if share else own)


def random_rows(seed, n):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(-45, 400), n):
        for turn in range(rng.choice((1, 2, 3, 4, 5, 8, 9, 13))):
            rows.append((conv, turn, rng.choice(("user", "assistant")), rng.choice(("a b", "c", "d e f", "")) if turn % 5 < 3 else "same turn"))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rows = random_rows(seed, 90)
    table = spark.createDataFrame(rows, DDL)
    assert shown(trie(table)) == brute(rebuilt(own_turns(rows)))
    assert shown(trie(table, share=False)) == brute(own_turns(rows))


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "no conversation"), (1, None, None, None), (1, 3, "user", "b"), (1, 3, "user", "a"), (1, 3, "user", "a"), (2, 0, "", "x " * 50_000),
        (3, 5, "user", None), (3, None, "user", None), (-7, 1, "é", "😀 ß"), (2**62, 0, "user", "far"), (40, 0, "user", "kept"), (41, 0, "user", "gone"),
    ]
    table = spark.createDataFrame(rows, DDL).withColumn("place", F.lit("old")).withColumn("X", F.lit(None)).withColumn("words", F.lit(1))
    assert shown(trie(table)) == brute(rebuilt(own_turns(rows)))
    assert trie(table.limit(0)).count() == 0


def test_copies_and_long_chains(spark):
    # Very many copies of one conversation, listed in several ranges, and one chain far longer than a block.
    rows = [(conv, t, "user", f"turn {t}") for conv in range(0, 9000, 2) for t in range(3)]
    rows += [(100_001, t, "user", f"turn {t}") for t in range(70)] + [(100_003, t, "user", f"turn {t}") for t in range(66)] + [(100_003, 66, "user", "end")]
    own = own_turns(rows)
    found = {(r[0], r[1]): r for r in shown(trie(spark.createDataFrame(rows, DDL), share=False))}
    assert found[0, 3][3:6] == (4502, 1, 2) and found[0, 3][7] == hashlib.sha256(",".join(map(str, range(0, 9000, 2))).encode()).hexdigest()
    chain = brute({conv: x for conv, x in own.items() if conv > 100_000})
    for r in chain:
        if r[1] > 3:
            assert found[r[0], r[1]][3:] == r[3:]
    assert len(found) == 1 + 70 + 1


def test_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{folder}/conversations.parquet'")
    found = con.execute(entry.oracle_sql()["op12_block_hash_trie"])
    df = entry.queries()["op12_block_hash_trie"](spark, folder)
    assert [d[0] for d in found.description] == df.columns
    assert shown(df) == sorted(found.fetchall(), key=str)
