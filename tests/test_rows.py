"""Duplicates, upserts, ingest counters, ordered windows on hot keys, selection."""

from __future__ import annotations

import datetime as dt
import random
from itertools import groupby

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stallwise.operators import activity, dedup, ingest, ordered, selection
from stallwise.plans import views

def as_of():
    return F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")

T0 = dt.datetime(2024, 1, 1)


def prices(spark, rows):
    return spark.createDataFrame(
        [(f"i{n}", p, "amazon", float(c), float(c) + 1, 5.0, ["x"], T0 + dt.timedelta(days=d), T0, n)
         for n, (p, d, c) in enumerate(rows)],
        "price_id string, product_id string, site string, current_price double, original_price double, "
        "discount_percentage double, offers array<string>, price_date timestamp_ntz, scraped_at timestamp_ntz, ingest_seq long",
    )


def test_second_copy_of_a_product_is_dropped(spark):
    rows = spark.createDataFrame(
        [("a", "amazon", "Test Product", "u", 1), ("b", "amazon", " test PRODUCT ", "u", 2), ("c", "amazon", "Test Product", "v", 3)],
        "product_id string, site string, name string, url string, ingest_seq long",
    )
    assert [r.product_id for r in dedup.drop_duplicates(rows, "products").orderBy("ingest_seq").collect()] == ["a", "c"]


row_lists = st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(1, 50)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(row_lists)
def test_dedup_and_upsert_are_idempotent_and_counters_add_up(spark, rows):
    df = prices(spark, rows)
    once = dedup.drop_duplicates(df, "pricing")
    seen = {}
    for n, (p, d, _) in enumerate(rows):
        seen.setdefault((p, d), n)
    assert {r.ingest_seq for r in once.collect()} == set(seen.values())
    assert dedup.drop_duplicates(once, "pricing").count() == once.count()
    latest = dedup.upsert(df, df, "product_id")
    assert {r.ingest_seq for r in latest.collect()} == {max(n for n, r in enumerate(rows) if r[0] == p) for p in {r[0] for r in rows}}
    counts = {r.status: r.n for r in ingest.ingest_counts(df, "pricing", as_of()).collect()}
    assert sum(counts.values()) == len(rows) and counts["duplicate"] == len(rows) - len(seen)


def test_ingest_reads_its_input_once_and_gives_rows(spark, tmp_path):
    df = prices(spark, [("a", 0, 1), ("a", 0, 2), ("b", 0, 3), ("c", 1, 4)]).withColumn("discount_percentage", F.when(F.col("product_id") != "c", 5.0))
    df = df.withColumn("original_price", F.when(F.col("product_id") != "c", F.col("original_price")))
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    kept, rejected, counters = ingest.ingest_into(df.mapInArrow(counted, df.schema), "pricing", as_of(), f"{tmp_path}/out")
    assert sorted(r.ingest_seq for r in kept.collect()) == [0, 2] and [r.product_id for r in rejected.collect()] == ["c"]
    assert rejected.first().overall_score < 0.76 and reads.value == 4
    assert {r.status: r.n for r in counters.collect()} == {"processed": 2, "duplicate": 1, "failed": 1}
    assert {r.status: r.n for r in ingest.ingest_counts(df.mapInArrow(counted, df.schema), "pricing", as_of()).collect()} == {"processed": 2, "duplicate": 1, "failed": 1}
    assert reads.value == 8
    empty = ingest.ingest_into(df.limit(0), "pricing", as_of(), f"{tmp_path}/none")
    assert [part.count() for part in empty] == [0, 0, 3]


def test_dedup_across_batches(spark):
    first, second = prices(spark, [("a", 0, 1), ("b", 0, 1)]), prices(spark, [("a", 0, 2), ("a", 1, 2), ("a", 1, 3)])
    seen = dedup.drop_duplicates(first, "pricing").select(dedup.signature_hash("pricing").alias("signature"))
    assert [r.ingest_seq for r in dedup.drop_seen(second, seen, "pricing").collect()] == [1]


def test_dedup_limits_rows_before_the_shuffle(spark):
    plan = dedup.drop_duplicates(prices(spark, [("a", 0, 1)]), "pricing")._jdf.queryExecution().executedPlan().toString()
    partial = plan.index("Partial")
    assert plan.index("Exchange") < partial and "WindowGroupLimit" in plan


def skewed_log(seed: int, n: int = 400):
    """Two thirds of the rows on one key, half of those at one moment."""
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = "hot" if rng.random() < 0.66 else rng.choice("abcde")
        minute = 77 if key == "hot" and rng.random() < 0.5 else rng.randrange(500)
        rows.append((key, T0 + dt.timedelta(minutes=minute), seq, rng.randrange(100)))
    return rows


@pytest.mark.parametrize("partitions", [None, 1, 7, 60])
@pytest.mark.parametrize("seed", [1, 2])
def test_ordered_windows_equal_brute_force(spark, partitions, seed):
    rows = skewed_log(seed)
    # A NULL is a key like any other.
    rows = [(None if k == "e" else k, *rest) for k, *rest in rows]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, seq long, v long").repartition(5)
    along = (["k"], ["ts", "seq"])
    previous, following, position = {}, {}, {}
    for _, group in groupby(sorted(rows, key=lambda r: (str(r[0]), r[1:])), key=lambda r: r[0]):
        group = list(group)
        for i, r in enumerate(group):
            previous[r[2]] = group[i - 1][3] if i else None
            following[r[2]] = group[i + 1][3] if i + 1 < len(group) else None
            position[r[2]] = i + 1
    back = ordered.previous_values(df, *along, {"v": "other"}, partitions)
    assert {r.seq: r.other for r in back.collect()} == previous
    ahead = ordered.next_values(df, *along, {"v": "other"}, partitions)
    assert {r.seq: r.other for r in ahead.collect()} == following
    numbered = ordered.row_numbers(df, *along, "at", partitions)
    assert {r.seq: r["at"] for r in numbered.collect()} == position
    assert back.columns == [*df.columns, "other"] and numbered.columns == [*df.columns, "at"]
    empty = df.where("false")
    assert ordered.row_numbers(empty, *along).count() == ordered.next_values(empty, *along, {"v": "o"}).count() == 0


def test_tasks_get_equal_shares_whatever_the_keys(spark):
    # Key 1 has ten times the rows of key 0, most of them at one moment, and a third key has a few.
    rows = [(0, T0 + dt.timedelta(minutes=i), i) for i in range(300)] + [(1, T0, i) for i in range(3000)] + [(2, T0, i) for i in range(5)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz, seq long").repartition(6)
    parts = ordered.lined_up(df, ["k"], ["ts", "seq"], 66)
    slices = {r.k: r.n for r in parts.groupBy("k").agg(F.count_distinct(ordered.PART).alias("n")).collect()}
    assert 4 <= slices[0] <= 8 and 50 <= slices[1] <= 62 and slices[2] <= 2
    assert max(r["count"] for r in parts.groupBy(ordered.PART).count().collect()) < 150


def test_price_trends_over_many_ranges(spark):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.7 else rng.choice("ab"), rng.randrange(20), rng.randrange(1, 90)) for _ in range(300)]
    pricing = prices(spark, rows)
    products = spark.createDataFrame(
        [(p, p, "x", "books", "amazon") for p in ("hot", "a", "none")],
        "product_id string, name string, brand string, category string, site string",
    )
    found = [
        sorted(map(str, views.product_price_trends(products, pricing, as_of(), partitions=n).collect())) for n in (1, 40)
    ]
    assert found[0] == found[1] and len(found[0]) > 200
    window = W.partitionBy("product_id").orderBy("price_date", "ingest_seq", "price_id", "current_price")
    plain = pricing.filter(views.since(pricing, "price_date", views.days_before(as_of(), 30))).withColumn("previous_price", F.lag("current_price").over(window))
    plain = plain.where("product_id <> 'b'").select("price_id", "current_price", "previous_price")
    trends = views.product_price_trends(products, pricing, as_of(), partitions=40).select("price_id", "current_price", "previous_price")
    assert sorted(map(str, plain.collect())) == sorted(map(str, trends.collect()))


def test_gaps_and_politeness(spark):
    log = spark.createDataFrame(
        [("a", T0, 1), ("a", T0 + dt.timedelta(seconds=1), 2), ("a", T0 + dt.timedelta(hours=30), 3), ("b", T0, 4)],
        "k string, ts timestamp_ntz, seq long",
    )
    end = F.lit(T0 + dt.timedelta(hours=40)).cast("timestamp_ntz")
    gaps = {(r.k, r.gap_start, r.gap_end) for r in activity.stale_gaps(log, "k", end).collect()}
    assert gaps == {("a", T0 + dt.timedelta(seconds=1), T0 + dt.timedelta(hours=30)), ("b", T0, None)}
    audit = {r.k: (r.requests, r.too_soon, r.smallest_gap) for r in activity.politeness_audit(log, "k").collect()}
    assert audit == {"a": (3, 1, 1.0), "b": (1, 0, None)}


def test_selection(spark):
    products = spark.createDataFrame(
        [("1", "amazon", "Red SHIRT", "clothing"), ("2", "flipkart", "jeans shirt", "clothing"), ("3", "amazon", "x", "books")],
        "product_id string, site string, name string, category string",
    )
    terms = {"clothing": ["shirt", "jeans", "dress"], "books": ["fiction"]}
    daily = {(r.site, r.term): r.products for r in selection.term_coverage(products, terms).collect()}
    assert daily[("amazon", "shirt")] == 1 and daily[("flipkart", "jeans")] == 1 and daily[("myntra", "shirt")] == 0
    assert len(daily) == 9
    weekly = selection.term_coverage(products, terms, first_terms=None, first_categories=1)
    assert weekly.count() == 9 and weekly.filter("term = 'dress'").count() == 3
    pricing = prices(spark, [("1", 24, 5), ("2", 23, 5)])
    stale = {r.product_id for r in selection.stale_prices(products, pricing, F.lit("2024-01-25 05:00:00").cast("timestamp_ntz"), 6).collect()}
    assert stale == {"2", "3"}


def test_batches_of_a_hot_site(spark):
    df = spark.range(1050).select(F.when(F.col("id") < 50, "b").otherwise("a").alias("site"), F.col("id").alias("ingest_seq"))
    for partitions in (None, 30):
        out = selection.assign_batches(df, "site", partitions=partitions).groupBy("site", "batch").count().collect()
        assert {(r.site, r.batch): r["count"] for r in out} == {("a", i): 100 for i in range(10)} | {("b", 0): 50}


def test_clean_parses_or_empties(spark):
    rows = spark.createDataFrame(
        [("1", '{"a":"b"}', '["x"]', "2024-01-05T10:00:00Z", False), ("2", "{bad", "[bad", "soon", True), ("3", None, None, None, None)],
        "product_id string, specifications string, images string, scraped_at string, processed boolean",
    )
    out = {r.product_id: r for r in ingest.clean(rows, "products").collect()}
    assert out["1"].specifications == {"a": "b"} and out["1"].images == ["x"]
    assert out["1"].scraped_at == dt.datetime(2024, 1, 5, 10)
    assert out["2"].specifications == {} and out["2"].images == [] and out["2"].scraped_at is None
    assert out["3"].specifications is None and "processed" not in out["1"].asDict()
