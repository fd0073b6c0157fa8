"""Streams run to the end over several files and compared with their batch twins."""

from __future__ import annotations

import datetime as dt
import os
import random

from pyspark.sql import functions as F

from stallwise.operators import dedup, ingest, metrics
from stallwise.plans import bindings
from stallwise.streaming import jobs, silence, timers

T0 = dt.datetime(2024, 1, 1)


def as_of():
    return F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")


def price_files(spark, folder):
    """Three files; each repeats some signatures of the ones before."""
    df = spark.range(300).select(
        F.concat(F.lit("i"), F.col("id")).alias("price_id"), (F.col("id") % 40).cast("string").alias("product_id"),
        F.lit("amazon").alias("site"), (F.col("id") + 1.0).alias("current_price"),
        F.when(F.col("id") % 5 > 0, F.col("id") + 2.0).alias("original_price"),
        F.when(F.col("id") % 5 > 0, F.lit(5.0)).alias("discount_percentage"), F.array(F.lit("x")).alias("offers"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 3).cast("int"))).alias("price_date"),
        F.lit(T0).cast("timestamp_ntz").alias("scraped_at"), F.col("id").alias("ingest_seq"),
    )
    for part in range(3):
        df.filter(f"ingest_seq >= {part * 100} and ingest_seq < {part * 100 + 100}").coalesce(1).write.mode("append").parquet(folder)
    return df


def test_stream_ingest_equals_batch(spark, tmp_path):
    folder = f"{tmp_path}/in"
    batch = price_files(spark, folder)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    kept, counts = jobs.ingest(stream, "pricing", as_of(), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    total = counts.agg(F.count("*").alias("batches"), *[F.sum(c).alias(c) for c in ("processed", "duplicates", "failures")]).first()
    expected = {r.status: r.n for r in ingest.ingest_counts(batch, "pricing", as_of()).collect()}
    assert total.batches == 3
    # Files may arrive in any order, so which copy comes first is free; how many are kept is not.
    assert total.duplicates == expected["duplicate"] == 300 - 120
    assert total.processed + total.failures == 120 and kept.count() == total.processed


def run_ingest(spark, schema, tmp_path):
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    kept, counts = jobs.ingest(stream, "pricing", as_of(), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    return sorted(map(str, kept.collect())), sorted(map(str, counts.collect()))


def test_replayed_batch_changes_nothing(spark, tmp_path):
    batch = price_files(spark, f"{tmp_path}/in")
    first = run_ingest(spark, batch.schema, tmp_path)
    # The last batch was written, but the job died before it was committed.
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    assert run_ingest(spark, batch.schema, tmp_path) == first
    assert run_ingest(spark, batch.schema, tmp_path) == first


def test_signatures_are_never_forgotten(spark, tmp_path):
    schema = price_files(spark, f"{tmp_path}/in").schema
    kept, _ = run_ingest(spark, schema, tmp_path)
    # The same rows again, in files and a run of their own: all are duplicates, and nothing of earlier batches is read.
    spark.read.parquet(f"{tmp_path}/in").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    again, counts = run_ingest(spark, schema, tmp_path)
    assert again == kept and "batch=3, rows=300, processed=0, duplicates=300, failures=0" in counts[-1]


def test_first_of_a_batch_is_chosen_by_order(spark, tmp_path):
    rows = spark.range(4000).select((F.col("id") % 7).cast("string").alias("signature"), (-F.col("id")).alias("ingest_seq"), F.array("id").alias("own"))
    rows.repartition(5).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
    found = jobs.run_to_end(jobs.first_of_batch(stream, ["signature"], ["ingest_seq"]), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert sorted(r.own[0] for r in found.collect()) == list(range(3993, 4000))


def test_a_silence_alerts_once_and_the_key_is_armed_again(spark, tmp_path):
    def hour(h):
        return T0 + dt.timedelta(hours=h)

    files = [
        [(1, hour(0)), (1, hour(30)), (2, hour(0)), (None, hour(1)), (3, None)], [(2, hour(24)), (1, hour(29)), (4, hour(40))], [(4, hour(64.5))],
        [(2, hour(90)), (1, hour(90))], [(2, hour(150))],
    ]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, "user_id long, ts timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
        name = next((tmp_path / "in" / str(i)).glob("*.parquet"))
        # Files are read in order of their times.
        os.utime(name, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema("user_id long, ts timestamp_ntz").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    with silence.keyed_state(spark):
        rows = jobs.run_to_end(silence.silence_alerts(stream, "user_id", "2 hours"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    found = sorted((str(r.user_id), r.first_seen, r.last_seen, r.rows, r.alert_at) for r in rows.collect())
    # User 2 comes back after exactly 24 hours, which is no silence yet; user 1's row of hour 29 comes late but counts.
    spells = [("1", 0, 0, 1), ("1", 29, 30, 2), ("1", 90, 90, 1), ("2", 0, 24, 2), ("2", 90, 90, 1), ("4", 40, 40, 1), ("4", 64.5, 64.5, 1), ("None", 1, 1, 1)]
    assert found == [(k, hour(a), hour(b), n, hour(b + 24)) for k, a, b, n in spells]


def test_spells_join_whatever_their_order(spark):
    rng = random.Random(4)
    for _ in range(50):
        times = [rng.randrange(0, 400) for _ in range(30)]
        spells = silence.joined([(t, t, 1) for t in times], 10)
        assert sum(n for *_, n in spells) == 30 and all(b[0] - a[1] > 10 for a, b in zip(spells, spells[1:]))
        halves = silence.joined(silence.joined([(t, t, 1) for t in times[:15]], 10) + [(t, t, 1) for t in times[15:]], 10)
        assert halves == spells


def event_stream(spark, tmp_path, n=500):
    df = spark.range(n).select(
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") * 37).cast("int"))).alias("ts"),
        (F.col("id") % 7).alias("user_id"), F.col("id").alias("seq"), F.lit("g").alias("name"),
        F.when(F.col("id") % 3 == 0, "counter").when(F.col("id") % 3 == 1, "gauge").otherwise("timer").alias("type"),
        F.col("id").cast("double").alias("value"),
    ).filter("not (user_id = 3 and id between 100 and 300)") if n else None
    df.coalesce(1).write.parquet(f"{tmp_path}/events")
    return df, spark.readStream.schema(df.schema).parquet(f"{tmp_path}/events")


def test_windows_equal_batch_up_to_the_watermark(spark, tmp_path):
    df, stream = event_stream(spark, tmp_path)
    rows = jobs.run_to_end(jobs.metric_windows(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    timed = df.withColumn("ts", F.col("ts").cast("timestamp"))
    closed = timed.agg(F.max("ts") - F.expr("interval 1 hour")).scalar()
    twin = jobs.window_rows(timed).filter(F.col("window_end") <= closed)
    assert sorted(map(str, rows.collect())) == sorted(map(str, twin.collect())) and rows.count() > 100


def test_silent_users_are_reported(spark, tmp_path):
    df, stream = event_stream(spark, tmp_path)
    rows = jobs.run_to_end(jobs.active_spells(stream, "user_id"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    silent = rows.filter("user_id = 3").collect()
    last = df.filter("user_id = 3 and seq < 100").agg(F.max("ts")).first()[0]
    assert len(silent) == 1 and silent[0].last_seen == last
    assert rows.filter("user_id <> 3").count() == 0


def test_stream_dedup_keeps_one_of_each(spark, tmp_path):
    _, stream = event_stream(spark, tmp_path)
    stream = stream.select("ts", F.when(F.col("user_id") < 6, F.col("user_id")).alias("user_id"), "name", "seq")
    first = jobs.first_within(stream, ["user_id", "name"], "ts", "100 days", ["ts", "seq"])
    rows = jobs.run_to_end(first, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    # A NULL is a key like any other.
    assert sorted((str(r.user_id), r.seq) for r in rows.collect()) == [*((str(i), i) for i in range(6)), ("None", 6)]


def test_stream_keys_agree_with_batch_signatures(spark):
    df = spark.createDataFrame([("p", " A b "), ("p", "a B")], "product_id string, content string")
    assert df.select(dedup.signature_hash("reviews")).distinct().count() == 1
    assert jobs.keyed_by_text(df, "content").select("copy_key").distinct().count() == 1
    assert bindings.tables_of("review_pages") == {"documents", "labels"}


def test_timer_windows_equal_batch_figures(spark, tmp_path):
    rng = random.Random(9)
    # One metric has most samples; some come out of order, in another file.
    rows = [(T0 + dt.timedelta(seconds=rng.randrange(20_000)), i, "hot" if rng.random() < 0.8 else rng.choice("ab"), rng.random() * 9, "timer") for i in range(3000)]
    rows += [(None, 9000, "a", 1.0, "timer"), (T0, 9001, "a", None, "timer"), (T0, 9002, "a", 5.0, "gauge"), (T0, 9003, None, 2.0, "timer")]
    ddl = "ts timestamp_ntz, seq long, name string, value double, type string"
    for part in range(3):
        spark.createDataFrame(rows[part::3], ddl).coalesce(2).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(ddl).parquet(f"{tmp_path}/in")
    with silence.keyed_state(spark):
        found = jobs.run_to_end(timers.timer_windows(stream), f"{tmp_path}/out", f"{tmp_path}/checkpoint").collect()
    want = {}
    end = max(r[0] for r in rows if r[0]) - dt.timedelta(hours=1)
    for hour in range(6):
        start = T0 + dt.timedelta(hours=hour)
        inside = spark.createDataFrame([r for r in rows if r[0] and r[3] is not None and r[2] and start <= r[0] < start + dt.timedelta(hours=1)], ddl)
        if start + dt.timedelta(hours=1) <= end:
            want |= {(start, r.key): r for r in metrics.timer_stats(inside).collect()}
    named = {(r.window_start, r.name): r for r in found if r.name is not None}
    assert set(named) == set(want) and max(r["count"] for r in found) == 100
    for key, r in want.items():
        assert (named[key]["count"], named[key].min, named[key].max, named[key].p95) == (r["count"], r.min, r.max, r.p95)
        assert abs(named[key].avg - r.avg) < 1e-12
    assert [r["count"] for r in found if r.name is None] == [1]


def test_scored_rows_hold_no_signature(spark, tmp_path):
    """Signatures are neither shuffled nor written with the rows: prices have theirs in their own columns."""
    batch = price_files(spark, f"{tmp_path}/in")
    kept, _ = run_ingest(spark, batch.schema, tmp_path)
    written = spark.read.parquet(f"{tmp_path}/out/scored")
    assert set(batch.columns) <= set(written.columns) and not {"signature", "_day"} & set(written.columns) and kept
    assert dedup.stored_signature("pricing", as_of()).keys() == {"product_id", "_day"}


def test_counts_alone_equal_those_of_ingest(spark, tmp_path):
    batch = price_files(spark, f"{tmp_path}/in")
    _, counts = run_ingest(spark, batch.schema, tmp_path)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    alone = jobs.ingest_counts(stream, "pricing", as_of(), f"{tmp_path}/alone", f"{tmp_path}/other")
    assert alone.agg(F.sum("rows"), F.sum("processed"), F.sum("duplicates"), F.sum("failures")).first() == (300, *[
        sum(int(c.split(f"{name}=")[1].split(",")[0].rstrip(")")) for c in counts) for name in ("processed", "duplicates", "failures")])


def test_unseen_of_each_entity_equals_batch(spark, tmp_path):
    """Stored signatures tell the same rows apart as the batch's, NULL ones too."""
    rows = [
        (n, name, site, f"u{n % 2}", None if n % 5 == 0 else f"p{n % 3}", content, None if n % 4 == 0 else T0 + dt.timedelta(hours=n * 9), f"i{n}", float(n))
        for n, (name, site, content) in enumerate([("Big ", "amazon", "Good"), ("big", "amazon", " good "), (None, None, None), ("x", None, "bad")] * 6)
    ]
    df = spark.createDataFrame(rows, "ingest_seq long, name string, site string, url string, product_id string, content string, price_date timestamp_ntz, price_id string, current_price double")
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    for entity in ("products", "reviews", "pricing"):
        stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
        with silence.keyed_state(spark):
            found = jobs.run_to_end(jobs.unseen(stream, entity, as_of()), f"{tmp_path}/{entity}", f"{tmp_path}/{entity}-checkpoint")
        expected = dedup.drop_duplicates(df, entity, as_of())
        assert sorted(r.ingest_seq for r in found.collect()) == sorted(r.ingest_seq for r in expected.collect())
