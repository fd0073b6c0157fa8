"""Landing, staging, warehouse loads, checks, metrics, alerts and reports on hand-written rows."""

from __future__ import annotations

import datetime as dt
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.functions import quality
from stallwise.operators import alerts, checks, dedup, ingest, metrics
from stallwise.plans import reports, views
from stallwise.sources import export, landing, staging, warehouse

T0 = dt.datetime(2024, 1, 20)


def at(value=T0):
    return F.lit(value).cast("timestamp_ntz")


def staged(spark, rows):
    return spark.createDataFrame(
        [(k, "amazon", "n", "books", '["x"]', v, T0, False, seq) for k, v, seq in rows],
        "product_id string, site string, name string, category string, images string, in_stock boolean, "
        "scraped_at timestamp_ntz, processed boolean, ingest_seq long",
    )


def test_landing(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ('q"x,\ny', 1)], "name string, n long")
    for fmt in ("json", "csv"):
        path = landing.write_raw(df, str(tmp_path), "things", fmt, fmt)
        assert sorted(map(str, landing.read_raw(spark, df.schema, path, fmt).collect())) == sorted(map(str, df.collect()))
    landing.write_raw(df.select("name"), str(tmp_path), "other", "b1", "text")
    listed = landing.list_raw(spark, str(tmp_path), "things/json").collect()
    assert listed and all(r.path.startswith("things/json/") and r.length >= 0 for r in listed)
    with pytest.raises(ValueError):
        landing.write_raw(df, str(tmp_path), "things", "b", "xml")


def rows_of(df):
    return sorted((r.product_id, r.in_stock, r.ingest_seq) for r in df.collect())


def test_incremental_load_and_replay(spark, tmp_path):
    root, load = str(tmp_path), lambda **k: warehouse.load_pending(spark, str(tmp_path), "products", **k)
    assert load() == 0
    warehouse.stage(staged(spark, [("a", True, 1), ("b", True, 2), ("b", False, 3)]), root, "products")
    warehouse.stage(staged(spark, [("c", True, 4)]), root, "products")
    assert [load(batches=1), load(), load()] == [2, 1, 0]
    warehouse.stage(staged(spark, [("a", False, 5)]), root, "products")
    # A load that died after writing rows and before its manifest entry: its folder is written again, not added to.
    warehouse.append(staged(spark, [("x", False, 9)]).drop("processed"), f"{root}/warehouse/products/load=6", "products")
    # So did a staged batch; it is not read until it is staged again under its number.
    staged(spark, [("y", False, 9)]).write.parquet(f"{root}/staging/products/batch=7")
    assert [load(), load()] == [1, 0]
    assert rows_of(warehouse.read_versions(spark, root, "products")) == [("a", False, 5), ("a", True, 1), ("b", False, 3), ("c", True, 4)]
    current = warehouse.read_current(spark, root, "products")
    assert rows_of(current) == [("a", False, 5), ("b", False, 3), ("c", True, 4)]
    stored = current.first()
    assert stored.images == ["x"] and str(stored.dt) == "2024-01-20"


def test_a_load_lists_only_the_new_batch(spark, tmp_path):
    root = str(tmp_path)
    for n in range(3):
        warehouse.stage(staged(spark, [("a", True, n), (f"k{n}", True, n)]), root, "products")
        rows, upto = warehouse.pending(spark, root, "products")
        assert rows.count() == 2 and upto == 2 * n + 1
        assert {f.split("/")[-2] for f in rows.inputFiles()} == {f"batch={upto}"}
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "InMemoryFileIndex(1 paths)" in plan and "Join" not in plan
        assert warehouse.load_pending(spark, root, "products") == 2


def test_compaction_and_merge_on_read(spark, tmp_path):
    root = str(tmp_path)

    def loaded(rows):
        warehouse.stage(staged(spark, rows), root, "products")
        return warehouse.load_pending(spark, root, "products")

    assert warehouse.compact(spark, root, "products") == 0
    loaded([("a", True, 1), ("b", True, 2)])
    loaded([("a", False, 3)])
    before = rows_of(warehouse.read_current(spark, root, "products"))
    assert warehouse.compact(spark, root, "products") == 2
    assert rows_of(warehouse.read_current(spark, root, "products")) == before == rows_of(warehouse.read_versions(spark, root, "products"))
    assert warehouse.compact(spark, root, "products") == 0
    # New, changed and late rows over the base.
    loaded([("c", True, 4), ("b", False, 5), ("a", True, 0)])
    want = [("a", False, 3), ("b", False, 5), ("c", True, 4)]
    assert rows_of(warehouse.read_current(spark, root, "products")) == want
    assert warehouse.compact(spark, root, "products") == 3
    assert rows_of(warehouse.read_current(spark, root, "products")) == want


def test_views_prune_days_and_keys_skip_row_groups(spark, tmp_path):
    day = [T0 - dt.timedelta(days=n) for n in range(0, 120, 10)]
    products = spark.createDataFrame(
        [(f"p{i}", "amazon", f"n{i}", "b", "books", "d", "{}", "[]", True, d, i) for i, d in enumerate(day)],
        "product_id string, site string, name string, brand string, category string, description string, specifications string, images string, in_stock boolean, scraped_at timestamp_ntz, ingest_seq long",
    )
    pricing = products.select(
        F.concat(F.lit("x"), "product_id").alias("price_id"), "product_id", "site", F.lit(5.0).alias("current_price"), F.lit(6.0).alias("original_price"),
        F.lit(1.0).alias("discount_percentage"), F.lit("[]").alias("offers"), F.col("scraped_at").alias("price_date"), "scraped_at", "ingest_seq",
    )
    reviews = spark.createDataFrame([], "review_id string, product_id string, rating double, verified_purchase boolean, review_date timestamp_ntz")
    scores = products.select(
        F.col("product_id").alias("record_id"), F.lit("product").alias("record_type"), *[F.lit(0.5).alias(f"{c}_score") for c in ("completeness", "accuracy", "consistency", "overall")],
        F.col("scraped_at").alias("evaluated_at"), F.to_date("scraped_at").alias("dt"),
    )
    for name, df in (("products", products), ("pricing", pricing)):
        warehouse.append(ingest.clean(df.withColumn("processed", F.lit(False)), name), f"{tmp_path}/{name}", name)
    scores.write.partitionBy("dt").parquet(f"{tmp_path}/scores")
    stored = {t: warehouse.read(spark, f"{tmp_path}/{t}") for t in ("products", "pricing", "scores")}
    found = {
        "daily": views.daily_scraping_summary(stored["products"], at()), "quality": views.quality_summary(stored["scores"], at()),
        "comparison": views.site_comparison(stored["products"], stored["pricing"], reviews, at()),
    }
    plain = {
        "daily": views.daily_scraping_summary(products, at()), "quality": views.quality_summary(scores.drop("dt"), at()),
        "comparison": views.site_comparison(products, pricing, reviews, at()),
    }
    for name, df in found.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[[^]]*dt#\d+ >= 20", plan), (name, plan)
        assert sorted(map(str, df.collect())) == sorted(map(str, plain[name].collect()))
    assert views.product_price_trends(stored["products"], stored["pricing"], at()).count() == 4
    # Prices lie by the day of the price, so the time of the scrape says nothing of their folder.
    assert views.stored_by_day_of(stored["pricing"], "price_date") and not views.stored_by_day_of(stored["pricing"], "scraped_at")
    growth = reports.weekly_growth({"products": (stored["products"], "scraped_at", at()), "pricing": (stored["pricing"], "scraped_at", at())})
    plan = growth._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"PartitionFilters: \[isnotnull\(dt", plan)) == 1
    assert sorted(map(str, growth.collect())) == sorted(map(str, reports.weekly_growth({"products": (products, "scraped_at", at()), "pricing": (pricing, "scraped_at", at())}).collect()))
    recent = stored["pricing"].filter(views.since(stored["pricing"], "price_date", views.days_before(at(), 30)))
    assert "PartitionFilters: [isnotnull(dt" in recent._jdf.queryExecution().executedPlan().toString()
    file = next((tmp_path / "pricing").rglob("*.parquet"))
    column = pq.ParquetFile(file).metadata.row_group(0)
    names = [column.column(i).path_in_schema for i in range(column.num_columns)]
    assert b"price_id" in file.read_bytes() and names.index("price_id") >= 0


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    path = f"{tmp_path}/w"
    warehouse.append(staged(spark, [("a", True, 1)]).drop("processed"), path, "products")
    df = warehouse.read(spark, path).filter("dt = date '2024-01-20' and site = 'amazon'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "EqualTo(site,amazon)" in plan


def test_replaced_row_is_unprocessed_again_and_retention(spark, tmp_path):
    versions = staged(spark, [("a", True, 1), ("a", False, 2), ("b", True, 3)])
    latest = staging.current(versions, "product_id")
    ledger = spark.createDataFrame([("a", 1), ("b", 3)], "product_id string, ingest_seq long")
    assert [(r.product_id, r.ingest_seq) for r in staging.pending(latest, ledger, "product_id").collect()] == [("a", 2)]
    staging.compact(versions, f"{tmp_path}/compacted", "product_id")
    assert spark.read.parquet(f"{tmp_path}/compacted").count() == 2
    kept = staging.retained(latest.drop("processed"), ledger, "product_id", at(T0 + dt.timedelta(days=31)), 30)
    assert [r.product_id for r in kept.collect()] == ["a"]


def test_what_cannot_be_summed_is_in_neither_sum_nor_divisor(spark):
    products = spark.createDataFrame(
        [(p, p, "b", "books", "amazon", T0) for p in "abc"], "product_id string, name string, brand string, category string, site string, scraped_at timestamp_ntz"
    )
    ratings = {"a": [4.0, float("nan"), 2.0], "b": [float("inf"), None, 1e20], "c": [0.00004, 1e17, 1.0]}
    reviews = spark.createDataFrame(
        [(f"{p}{i}", p, r, True, T0) for p, own in ratings.items() for i, r in enumerate(own)],
        "review_id string, product_id string, rating double, verified_purchase boolean, review_date timestamp_ntz",
    )
    summary = {r.product_id: r.avg_rating for r in views.product_review_summary(products, reviews).collect()}
    assert summary["a"] == 3.0 and summary["b"] is None and summary["c"] == pytest.approx((1e17 + 1.00004) / 3, rel=1e-15)
    amounts = {"a": [9e15, 9e15], "b": [float("nan"), 5.0], "c": [1e17, float("-inf")]}
    pricing = spark.createDataFrame(
        [(p, v, 10.0, T0) for p, own in amounts.items() for v in own], "product_id string, current_price double, discount_percentage double, price_date timestamp_ntz"
    )
    for fan_out in (True, False):
        row = views.site_comparison(products, pricing, reviews, at(), fan_out=fan_out).first()
        # Each product has three reviews and two prices, so both ways of weighing agree.
        assert row.avg_current_price == pytest.approx((9e15 * 2 + 5 + 1e17) / 4, rel=1e-15)
        assert row.avg_discount == 10.0 and row.total_reviews == 9
        assert row.avg_rating == pytest.approx((6 + 1e17 + 1.00004) / 5, rel=1e-15)


def scores(spark, values):
    return spark.createDataFrame(
        [(str(i), "product", v, v, v, v, [], T0) for i, v in enumerate(values)], schemas.QUALITY_SCORES
    )


@pytest.mark.parametrize("values, status", [([0.9, 0.9, 0.1], "FAIL"), ([0.9, 0.9, 0.9, 0.1], "PASS"), ([], "NO_DATA")])
def test_data_quality(spark, values, status):
    assert checks.data_quality(scores(spark, values)).first().status == status


def test_checks_alerts_and_status(spark):
    rows = staged(spark, [("a", True, 1), ("b", None, 2)]).withColumns({"url": F.lit("u"), "brand": F.lit("")})
    empty = rows.limit(0)
    profile = checks.profiles({"products": rows, "none": empty}, at(T0 + dt.timedelta(hours=1)))
    filled = {r.table: (r.avg_completeness, r.status) for r in checks.completeness(profile).collect()}
    assert filled["products"][0] == pytest.approx(19 / 22) and filled["none"][1] == "NO_DATA"
    fresh = {r.table: r.status for r in checks.freshness(profile).collect()}
    assert fresh == {"products": "PASS", "none": "NO_DATA"}
    cover = {r.table: (r.missing_sites, r.status) for r in checks.site_coverage(profile).collect()}
    assert cover == {"products": ("flipkart,myntra", "PARTIAL"), "none": ("", "PASS")}
    assert {r.site for r in checks.missing_sites(rows).collect()} == {"flipkart", "myntra"}
    found = spark.createDataFrame(
        [("data_quality", "FAIL", 0.345), ("freshness", "STALE", 0.0), ("site_coverage", "PARTIAL", 1.0), ("duplicates", "PASS", 0.0)],
        "check string, status string, measure double",
    )
    raised = checks.quality_alerts(found)
    assert {(r.type, r.severity, r.message) for r in raised.collect()} == {
        ("LOW_DATA_QUALITY", "HIGH", "Low quality rate: 34.5%"), ("STALE_DATA", "MEDIUM", "Data appears to be stale"),
        ("INCOMPLETE_SITE_COVERAGE", "MEDIUM", "Not all sites are being scraped"),
    }
    assert checks.overall_status(raised).first().overall_status == "ALERT"
    assert checks.overall_status(raised.filter("severity = 'MEDIUM'")).first().overall_status == "WARNING"
    assert checks.overall_status(raised.limit(0)).first().overall_status == "PASS"
    health = checks.health_metrics(found, checks.data_quality(scores(spark, [0.5])).select("avg_overall_score").scalar()).first()
    assert (health.overall_health_score, health.avg_quality_score) == (0.625, 0.5)
    assert checks.report_rows(found, raised).count() == 7


def test_all_checks_read_each_table_once(spark, tmp_path):
    rows = staged(spark, [("a", True, 1), ("b", None, 2), ("a", True, 3)]).withColumns({"url": F.lit("https://amazon.in/x"), "brand": F.lit("n"), "description": F.lit(None).cast("string"), "specifications": F.lit("{}")})
    rows.write.parquet(f"{tmp_path}/products")
    stored = spark.read.parquet(f"{tmp_path}/products")
    jobs = spark.createDataFrame([], "status string, created_at timestamp_ntz")
    profile = checks.profiles({"products": stored}, at(T0 + dt.timedelta(hours=1)), whole=True)
    found = checks.run_checks(profile, jobs, at())
    status = checks.overall_status(checks.quality_alerts(found))
    status.collect()
    assert status._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    got = {r.check: (r.status, r.measure) for r in found.collect()}
    assert got["duplicates"] == ("FAIL", pytest.approx(2 / 3)) and got["site_coverage"] == ("PARTIAL", 1.0) and got["freshness"] == ("PASS", 1.0)
    scored = quality.with_scores(ingest.parse_json_columns(stored, "products"), "products", at(T0 + dt.timedelta(hours=1)))
    mean = scored.agg(F.avg("overall_score")).first()[0]
    assert checks.health_metrics(found, checks.average_quality(profile)).first().avg_quality_score == pytest.approx(mean)
    none = checks.profiles({"products": stored.limit(0)}, at(), whole=True)
    assert {r.check: r.status for r in checks.run_checks(none, jobs, at()).collect()} == {
        "data_quality": "NO_DATA", "completeness": "PASS", "freshness": "STALE", "duplicates": "PASS", "site_coverage": "PASS", "processing_health": "PASS",
    }


def samples(spark, rows):
    return spark.createDataFrame(
        [(T0 + dt.timedelta(seconds=s), s, n, float(v), k, labels) for s, n, v, k, labels in rows],
        "ts timestamp_ntz, seq long, name string, value double, type string, labels map<string,string>",
    )


@pytest.mark.parametrize("n, p95", [(20, 20.0), (21, 20.0), (1, 1.0), (150, 146.0)])
def test_timer_stats(spark, n, p95):
    df = samples(spark, [(i, "t", i, "timer", {}) for i in range(1, n + 1)])
    row = metrics.timer_stats(df).first()
    assert (row["count"], row.p95, row.max) == (min(n, 100), p95, float(n))


def test_counters_and_gauges_keep_labels_apart(spark):
    df = samples(spark, [(1, "c", 1, "counter", {"s": "a"}), (2, "c", 2, "counter", {"s": "b"}), (3, "c", 4, "counter", {"s": "a"}),
                         (4, "g", 7, "gauge", None), (5, "g", 3, "gauge", None)])
    assert {r.key: r.value for r in metrics.counters(df).collect()} == {"c{s=a}": 5.0, "c{s=b}": 2.0}
    assert {r.key: r.value for r in metrics.gauges(df).collect()} == {"g": 3.0}
    assert metrics.summary(df).count() == 3


def test_metric_export(spark, tmp_path):
    df = samples(spark, [(1, "c", 1, "counter", {"s": "a"}), (2, "g", 2, "gauge", {})])
    export.write_metrics(df, f"{tmp_path}/csv", "csv")
    rows = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/csv").orderBy("timestamp").collect()
    assert rows[0].labels == '{"s":"a"}' and not rows[1].labels and rows[0].timestamp == "2024-01-20T00:00:01.000000"
    export.write_metrics(df, f"{tmp_path}/json", "json")
    assert spark.read.json(f"{tmp_path}/json/samples").count() == 2
    assert {r.key for r in spark.read.json(f"{tmp_path}/json/summary").collect()} == {"c{s=a}", "g"}
    assert [r.seq for r in metrics.recent(df, 1).collect()] == [2]
    with pytest.raises(ValueError):
        export.write_metrics(df, f"{tmp_path}/x", "xml")


def test_stored_bytes_come_from_the_listing(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/a/x=1")
    spark.range(10).write.parquet(f"{tmp_path}/b")
    found = {r.table: r for r in reports.storage_cost(reports.stored_bytes(spark, {t: f"{tmp_path}/{t}" for t in "ab"}), 2.0, 10.0).collect()}
    size = {t: sum(f.stat().st_size for f in (tmp_path / t).rglob("*.parquet")) for t in "ab"}
    assert {t: r.bytes for t, r in found.items()} == size and found["a"].cost == size["a"] / 1e9 * 2
    assert found["a"].share + found["b"].share == pytest.approx(1) and found["b"].remaining_budget == pytest.approx(10 - sum(size.values()) / 1e9 * 2)
    plan = reports.stored_bytes(spark, {"a": f"{tmp_path}/a"})._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_alerts(spark):
    rules = alerts.rules_frame(spark, {"mine": {"metric": "x", "threshold": 1, "operator": "~", "severity": "LOW", "message": "m"}})
    gauges = spark.createDataFrame([("error_rate", 20.0), ("data_quality_score", 0.9)], "key string, value double")
    out = {r.rule_name: (r.current_value, r.has_data) for r in alerts.active(gauges, rules).collect()}
    assert out == {"high_error_rate": (20.0, True), "low_success_rate": (0.0, False)}
    with pytest.raises(ValueError):
        alerts.rules_frame(spark, {"bad": {"metric": "x"}})


@pytest.mark.parametrize("partitions", [None, 25])
def test_alert_episodes(spark, partitions):
    values = [1, 20, 30, 5, 6, 40, 50]
    df = samples(spark, [(i, "error_rate", v, "gauge", None) for i, v in enumerate(values)])
    found = alerts.history(df, alerts.rules_frame(spark), partitions).orderBy("started_seq").collect()
    ends = [None if r.resolved_at is None else (r.resolved_at - T0).seconds for r in found]
    assert [(r.started_seq, r.current_value) for r in found] == [(1, 20.0), (5, 40.0)] and ends == [3, None]
    episodes = alerts.history(df, alerts.rules_frame(spark), partitions)
    assert [r.started_seq for r in alerts.recent(episodes, 1).collect()] == [5]
    assert tuple(alerts.summary(episodes).first())[1:] == ("HIGH", 2, 1)


def test_site_comparison_weighs_like_the_row_join(spark):
    products = spark.createDataFrame(
        [("a", "s", "c"), ("b", "s", "c"), ("old", "s", "c"), ("none", "s", "c")], "product_id string, site string, category string"
    ).withColumn("scraped_at", at())
    pricing = spark.createDataFrame(
        [("a", 10.0, 1.0, T0), ("a", 20.0, None, T0), ("b", 40.0, 5.0, T0), ("b", 1.0, 1.0, T0 - dt.timedelta(days=30)),
         ("old", 99.0, 1.0, T0 - dt.timedelta(days=30))],
        "product_id string, current_price double, discount_percentage double, price_date timestamp_ntz",
    )
    reviews = spark.createDataFrame(
        [("a", "r1", 5.0), ("a", "r2", 4.0), ("a", "r2", 3.0), ("none", "r1", 1.0), ("old", "r9", 1.0)],
        "product_id string, review_id string, rating double",
    )
    row = views.site_comparison(products, pricing, reviews, at()).first()
    # Rows of the join: a has 2 x 3, b has 1, none has 1; old drops out.
    assert (row.total_products, row.total_reviews) == (3, 2)
    assert row.avg_current_price == pytest.approx((3 * 30 + 40) / 7) and row.avg_discount == pytest.approx((3 * 1 + 5) / 4)
    assert row.avg_rating == pytest.approx((2 * 12 + 1) / 7)
    flat = views.site_comparison(products, pricing, reviews, at(), fan_out=False).first()
    assert flat.avg_current_price == pytest.approx(70 / 3) and flat.avg_rating == pytest.approx(13 / 4)


def test_costs_growth_and_advice(spark):
    usage = spark.createDataFrame([(dt.date(2024, 1, 1), 100, 10)], "month date, stored_rows long, jobs long")
    row = reports.cost_report(usage, {"storage_per_row": 1.0, "query_per_row": 2.0, "compute_per_job": 5.0}, 700.0).first()
    assert (row.total_cost, row.remaining_budget, row.utilization_percentage) == (350.0, 350.0, 50.0)
    df = spark.createDataFrame([(T0 - dt.timedelta(days=d),) for d in (1, 2, 8, 20)], "ts timestamp_ntz")
    growth = reports.weekly_growth({"t": (df, "ts", at())}).first()
    assert (growth.current_rows, growth.previous_rows, growth.growth_percentage) == (2, 1, 100.0)
    gauges = spark.createDataFrame([("data_quality_score", 0.5), ("memory_usage_percentage", 90.0)], "key string, value double")
    assert reports.recommendations(gauges).count() == 2
    assert reports.recommendations(gauges.limit(0)).count() == 1


@pytest.mark.parametrize("few", [500_000, 0])
def test_latest_of_few(spark, monkeypatch, few):
    """The latest of each key, a NULL one too, whether few or many keys have several versions."""
    monkeypatch.setattr(dedup, "FEW_KEYS", few)
    df = staged(spark, [("a", True, 1), ("a", False, 3), ("a", True, 2), ("b", True, 1), (None, True, 1), (None, False, 2)])
    found = dedup.latest_of_few(df, "product_id")
    assert found.columns == df.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, dedup.latest_rows(df, "product_id").collect()))
    assert found.count() == 3


def test_loaded_rows_pass_one_shuffle(spark, tmp_path):
    """Rows whose keys have one version are not dealt out by key."""
    staged(spark, [(f"k{n}", True, n) for n in range(50)]).write.parquet(f"{tmp_path}/in")
    plan = dedup.latest_of_few(spark.read.parquet(f"{tmp_path}/in"), "product_id")._jdf.queryExecution().optimizedPlan().toString()
    once = plan.split("Union", 1)[1].split("Window", 1)[0]
    assert "isnull(_several" in once and "Repartition" not in once


def test_key_filters_fit_their_files(spark, tmp_path):
    """A day of few rows takes a small filter, not one of 1 MB."""
    rows = [(f"k{n}", True, n) for n in range(30)]
    warehouse.stage(staged(spark, rows).withColumn("scraped_at", F.col("scraped_at") + F.make_dt_interval(days=(F.col("ingest_seq") % 3).cast("int"))), str(tmp_path), "products")
    assert warehouse.load_pending(spark, str(tmp_path), "products") == 30
    files = list((tmp_path / "warehouse").rglob("*.parquet"))
    assert len(files) >= 3 and max(f.stat().st_size for f in files) < 100_000
    assert all(pq.ParquetFile(f).metadata.row_group(0).column(0).compression == "ZSTD" for f in files)


def test_more_tasks_for_more_rows(spark, monkeypatch):
    monkeypatch.setattr(warehouse, "ROWS_PER_TASK", 5)
    df = staged(spark, [(f"k{n}", True, n) for n in range(40)])
    assert warehouse._by_day(df, "products", 40).rdd.getNumPartitions() == 8
