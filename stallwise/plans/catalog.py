"""The registered queries: each binds the test tables and runs one operator over all of their rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.functions import quality, text
from stallwise.operators import activity, alerts, checks, dedup, ingest, metrics, ordered, pages, selection
from stallwise.plans import bindings, reports, views
from stallwise.plans.bindings import AS_OF, METRICS_AS_OF, PRICES_AS_OF, timestamp
from stallwise.sources import export, html, landing, scratch, staging, warehouse
from stallwise.streaming import jobs as streams
from stallwise.streaming import silence, timers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Inputs of the cost report: rupees per row and per job, and the monthly budget.
RATES = {"storage_per_row": 0.25, "query_per_row": 0.5, "compute_per_job": 1.5, "storage_per_gigabyte": 1.75}
BUDGET = 1515.0
# Words that occur in the test products' names, in the place of the search terms.
TEST_TERMS = {
    "electronics": ["red", "gear", "bolt"], "clothing": ["blue", "ring", "gizmo"], "home-kitchen": ["small", "widget"],
    "books": ["hot", "cold", "big"], "sports": ["large", "ring", "bolt"],
}


def query(*names: str):
    """Register a function of (spark, bound frames...) under its own name."""
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(spark, *bindings.load(spark, sf_dir, *names))

        run.__doc__ = build.__doc__
        QUERIES[build.__name__] = run
        return build

    return register


def rounded(df: DataFrame, *columns: str, digits: int = 4) -> DataFrame:
    """Round half up by floor; the engines' own round functions break ties differently."""
    scale = 10**digits
    return df.withColumns({c: F.floor(F.col(c) * scale + 0.5) / scale for c in columns})


def typed(df: DataFrame, entity: str) -> DataFrame:
    return ingest.parse_json_columns(df, entity)


SCORES = ("completeness_score", "accuracy_score", "consistency_score", "overall_score")


def all_scores(products: DataFrame, reviews: DataFrame, pricing: DataFrame) -> DataFrame:
    """Scores as nightly runs leave them: each row is scored at two o'clock of the night after its scrape."""
    as_of, night = timestamp(AS_OF), F.date_trunc("day", "scraped_at") + F.expr("interval 26 hours")
    return (
        quality.score_rows(typed(products, "products"), "products", as_of, night)
        .unionByName(quality.score_rows(reviews, "reviews", as_of, night))
        .unionByName(quality.score_rows(typed(pricing, "pricing"), "pricing", as_of, night))
    )


def labelled(samples: DataFrame) -> DataFrame:
    return samples.withColumn("labels", F.create_map(F.lit("site"), F.col("site_label"))).drop("site_label")


def unlabelled(samples: DataFrame) -> DataFrame:
    return samples.drop("site_label").withColumn("labels", F.lit(None).cast("map<string,string>"))


# --- sources and sinks -------------------------------------------------------------------------------------------


@query("products")
def raw_landing_roundtrip(spark, products):
    root = scratch.new_folder(spark, "landing")
    path = landing.write_raw(products, root, "products", "20240125")
    back = landing.read_raw(spark, products.schema, path)
    return back.select("product_id", "site", "name", "brand", "url", "in_stock", "scraped_at")


@query("products", "reviews")
def raw_file_listing(spark, products, reviews):
    root = scratch.new_folder(spark, "landing")
    folder = F.regexp_extract("path", "^[^/]*/[^/]*", 0).alias("folder")
    records = []
    for data_type, df in (("products", products), ("reviews", reviews)):
        path = landing.write_raw(df, root, data_type, "20240125")
        records.append(landing.read_raw(spark, df.schema, path).agg(F.lit(f"{data_type}/20240125").alias("folder"), F.count("*").alias("records")))
    files = landing.list_raw(spark, root).groupBy(folder).agg((F.sum("length") > 0).alias("has_bytes"))
    return records[0].union(records[1]).join(files, "folder")


def _changed(df: DataFrame, column: str, value) -> DataFrame:
    """A second batch: every third row again, changed and with a later sequence number."""
    return df.filter(F.col("ingest_seq") % 3 == 0).withColumns(
        {column: value, "ingest_seq": F.col("ingest_seq") + 10_000_000_000}
    )


@query("products")
def upsert_products(spark, products):
    incoming = _changed(products, "in_stock", ~F.col("in_stock"))
    return dedup.upsert(products, incoming, "product_id").select("product_id", "name", "in_stock", "ingest_seq")


@query("reviews")
def upsert_reviews(spark, reviews):
    latest = dedup.upsert(reviews, _changed(reviews, "rating", F.lit(3.0)), "review_id")
    return latest.select("review_id", "product_id", "rating", "ingest_seq")


@query("pricing")
def upsert_pricing(spark, pricing):
    incoming = _changed(pricing, "current_price", F.col("current_price") + 1)
    order = ["ingest_seq", "product_id", "current_price", "original_price", "discount_percentage"]
    return rounded(
        dedup.upsert(pricing, incoming, "price_id", order).select("price_id", "current_price", "ingest_seq"),
        "current_price",
    )


@query("jobs")
def upsert_jobs(spark, jobs):
    first = jobs.withColumn("ingest_seq", F.col("job_id").cast("long"))
    done = first.filter("status = 'running'").withColumns(
        {"status": F.lit("completed"), "ingest_seq": F.col("ingest_seq") + 10_000_000_000}
    )
    return dedup.upsert(first, done, "job_id").select("job_id", "site", "job_type", "status", "created_at")


@query("products")
def upsert_quality(spark, products):
    rows = typed(products, "products")
    early = quality.score_rows(rows, "products", timestamp("2024-01-10 00:00:00")).withColumn("ingest_seq", F.lit(1))
    late = quality.score_rows(rows.filter("ingest_seq % 2 = 0"), "products", timestamp(AS_OF)).withColumn(
        "ingest_seq", F.lit(2)
    )
    latest = dedup.upsert(early, late, "record_id").select("record_id", "consistency_score", "overall_score")
    return rounded(latest, "consistency_score", "overall_score")


def _staged(products: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two versions of some rows, and a ledger of the first version of the rows with an even sequence number."""
    versions = products.unionByName(_changed(products, "in_stock", ~F.col("in_stock")))
    ledger = staging.marks(products.filter("ingest_seq % 2 = 0"), "product_id")
    return staging.current(versions, "product_id"), ledger


@query("products")
def unprocessed_scan(spark, products):
    latest, ledger = _staged(products)
    return staging.pending(latest, ledger, "product_id").select("product_id", "in_stock", "ingest_seq")


@query("products")
def mark_processed(spark, products):
    latest, ledger = _staged(products)
    todo = staging.pending(latest, ledger, "product_id")
    whole = ledger.unionByName(staging.marks(todo, "product_id"))
    return staging.with_processed(latest, whole, "product_id").groupBy("site", "processed").agg(
        F.count("*").alias("rows")
    )


@query("products")
def warehouse_partitioned_read(spark, products):
    path = f"{scratch.new_folder(spark, 'warehouse')}/products"
    warehouse.append(ingest.clean(products, "products"), path, "products")
    week = warehouse.read(spark, path).filter((F.col("dt") >= "2024-01-18") & (F.col("site") == "amazon"))
    return week.select("product_id", "category", F.array_join("images", "|").alias("images"), "in_stock", "dt")


@query("reviews")
def incremental_load(spark, reviews):
    path = f"{scratch.new_folder(spark, 'warehouse')}/reviews"
    for part in (0, 1):
        warehouse.append(ingest.clean(reviews.filter(F.col("ingest_seq") % 2 == part), "reviews"), path, "reviews")
    return warehouse.read(spark, path).groupBy("dt", "site").agg(
        F.count("*").alias("rows"), F.countDistinct("review_id").alias("reviews")
    )


@query("products", "pricing")
def adhoc_sql(spark, products, pricing):
    views.register_views(spark, {"shop_products": products, "shop_pricing": pricing})
    return spark.sql("""
        select p.site, p.category, count(*) as prices, max(r.current_price) as top_price
        from shop_products p join shop_pricing r on p.product_id = r.product_id
        where r.price_date >= timestamp_ntz '2001-01-01 00:00:00' group by p.site, p.category
    """)


@query("products", "reviews", "pricing")
def process_all_pending(spark, products, reviews, pricing):
    """Two rounds: the second loads the rows that were replaced after the first."""
    root = scratch.new_folder(spark, "load")
    tables = {"products": products, "reviews": reviews, "pricing": pricing}
    for name, df in tables.items():
        warehouse.stage(df, root, name)
    first = warehouse.process_all_pending(spark, root)
    warehouse.stage(_changed(products, "in_stock", ~F.col("in_stock")), root, "products")
    second = warehouse.process_all_pending(spark, root)
    rows = [(t, first[t], second[t]) for t in tables]
    marked = spark.createDataFrame(rows, "table string, first_round long, second_round long")
    in_target = checks._union([
        warehouse.read_versions(spark, root, t).agg(F.lit(t).alias("table"), F.count("*").alias("target_rows"))
        for t in tables
    ])
    return marked.join(in_target, "table")


def _loaded(spark, products) -> str:
    """Four staged batches of products in three loads, compacted after the second: the root of the tables."""
    root = scratch.new_folder(spark, "load")
    for part in (0, 1):
        warehouse.stage(products.filter(F.col("ingest_seq") % 2 == part), root, "products")
    warehouse.load_pending(spark, root, "products", batches=1)
    warehouse.load_pending(spark, root, "products")
    warehouse.compact(spark, root, "products")
    warehouse.stage(_changed(products, "in_stock", ~F.col("in_stock")), root, "products")
    # Late rows: older than what is loaded, so they change nothing.
    warehouse.stage(products.filter("ingest_seq % 5 = 0").withColumns({"name": F.lit("late"), "ingest_seq": F.col("ingest_seq") - 1_000_000_000}), root, "products")
    warehouse.load_pending(spark, root, "products")
    return root


@query("products")
def current_after_loads(spark, products):
    """Merge on read: the latest version of each product over a base and a delta."""
    rows = warehouse.read_current(spark, _loaded(spark, products), "products")
    return rows.select("product_id", "name", "in_stock", F.array_join("images", "|").alias("images"), "ingest_seq", "dt")


@query("products")
def loaded_versions(spark, products):
    """The row versions in the warehouse, each with its load."""
    rows = warehouse.read_versions(spark, _loaded(spark, products), "products")
    return rows.select("load", "product_id", "in_stock", "ingest_seq")


@query("products")
def retention_cleanup(spark, products):
    latest, ledger = _staged(products)
    kept = staging.retained(latest, ledger, "product_id", timestamp("2024-02-10 00:00:00"), 30)
    return kept.select("product_id", "scraped_at", "processed")


@query("products", "reviews", "pricing")
def retention_counts(spark, products, reviews, pricing):
    """Kept and dropped rows of each staging table; rows with an even sequence number are loaded."""
    versions = {"products": products, "reviews": reviews, "pricing": pricing}
    until = {"products": "2024-02-10 00:00:00", "reviews": "2024-02-10 00:00:00", "pricing": "1998-06-01 00:00:00"}
    parts = []
    for name, df in versions.items():
        key = schemas.PRIMARY_KEY[name]
        order = ["ingest_seq"] if name != "pricing" else ["ingest_seq", "product_id", "current_price", "original_price", "discount_percentage"]
        latest = dedup.latest_rows(df, key, order)
        ledger = staging.marks(latest.filter("ingest_seq % 2 = 0"), key)
        counts = staging.retention_counts(latest, ledger, key, timestamp(until[name]), 30)
        parts.append(counts.select(F.lit(name).alias("table"), "kept", "dropped"))
    return checks._union(parts)


@query("metrics")
def metrics_export_json(spark, samples):
    """The JSON export read back."""
    folder = scratch.new_folder(spark, "metrics")
    export.write_metrics(labelled(samples), folder, "json")
    return rounded(export.read_metrics(spark, folder).select("ts", "name", "value", "type", F.col("labels")["site"].alias("site")), "value")


@query("metrics")
def recent_metrics(spark, samples):
    """The buffer of the last thousand samples."""
    return rounded(metrics.recent(samples, 1000).select("ts", "seq", "name", "value"), "value")


@query("metrics")
def metrics_export(spark, samples):
    folder = scratch.new_folder(spark, "metrics")
    export.write_metrics(labelled(samples), f"{folder}/csv", "csv")
    export.write_metrics(labelled(samples), f"{folder}/json", "json")
    rows = spark.read.option("header", True).option("escape", '"').schema(
        "timestamp string, metric string, value double, type string, labels string"
    ).csv(f"{folder}/csv")
    return rows


# --- projections, filters, routing -------------------------------------------------------------------------------


def _entity(name: str):
    return typed if name != "reviews" else (lambda df, entity: df)


@query("products", "reviews", "pricing")
def constraint_violations(spark, products, reviews, pricing):
    parts = [
        ingest.with_violations(df, name).select(
            F.lit(name).alias("entity"), F.explode("violations").alias("violation")
        )
        for name, df in (("products", products), ("reviews", reviews), ("pricing", pricing))
    ]
    return checks._union(parts).groupBy("entity", "violation").agg(F.count("*").alias("rows"))


@query("products", "reviews", "pricing")
def quarantine_counts(spark, products, reviews, pricing):
    parts = []
    for name, df in (("products", products), ("reviews", reviews), ("pricing", pricing)):
        bad = F.size("violations") > 0
        parts.append(ingest.with_violations(df, name).agg(
            F.lit(name).alias("entity"), F.count_if(~bad).alias("valid"), F.count_if(bad).alias("quarantined")
        ))
    return checks._union(parts)


def _register_gates_and_ingests() -> None:
    as_of = {"products": AS_OF, "reviews": AS_OF, "pricing": PRICES_AS_OF}
    for entity, key in (("products", "product_id"), ("reviews", "review_id"), ("pricing", "price_id")):
        def gated(spark, df, entity=entity, key=key):
            scored = quality.with_scores(typed(df, entity), entity, timestamp(as_of[entity]))
            return rounded(ingest.gate(scored, entity).select(key, "ingest_seq", "overall_score"), "overall_score")

        def ingested(spark, df, entity=entity):
            return ingest.ingest_counts(typed(df, entity), entity, timestamp(as_of[entity]))

        def unique(spark, df, entity=entity, key=key):
            return dedup.drop_duplicates(df, entity, timestamp(as_of[entity])).select(key, "site", "ingest_seq")

        def scored(spark, df, entity=entity):
            rows = quality.score_rows(typed(df, entity), entity, timestamp(as_of[entity]))
            return rounded(
                rows.select("record_id", "record_type", *SCORES, F.array_join("issues", "; ").alias("issues")), *SCORES
            )

        for prefix, build in (("gate", gated), ("ingest", ingested), ("dedup", unique), ("score", scored)):
            build.__name__ = f"{prefix}_{entity}"
            query(entity)(build)


_register_gates_and_ingests()


@query("products")
def clean_products(spark, products):
    broken = products.withColumns({
        "specifications": F.when(F.col("ingest_seq") % 7 == 0, "{broken").otherwise(F.col("specifications")),
        "images": F.when(F.col("ingest_seq") % 11 == 0, "[oops").otherwise(F.col("images")),
        "scraped_at": F.when(F.col("ingest_seq") % 5 == 0, "yesterday").otherwise(
            F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
        ),
        "processed": F.lit(False),
    })
    cleaned = ingest.clean(broken, "products")
    return cleaned.select(
        "product_id", "scraped_at", F.try_element_at("specifications", F.lit("size")).alias("size"),
        F.coalesce(F.size("specifications"), F.lit(0)).alias("n_specifications"), F.array_join("images", "|").alias("images"),
    )


@query("pricing")
def clean_pricing(spark, pricing):
    texts = pricing.withColumns({
        "price_date": F.date_format("price_date", "yyyy-MM-dd'T'HH:mm:ss"),
        "scraped_at": F.when(F.col("ingest_seq") % 9 == 0, "").otherwise(
            F.date_format("scraped_at", "yyyy-MM-dd HH:mm:ss")),
        "processed": F.lit(True),
    })
    return ingest.clean(texts, "pricing").select(
        "price_id", "price_date", "scraped_at", F.array_join("offers", "|").alias("offers")
    )


@query("reviews")
def clean_reviews(spark, reviews):
    texts = reviews.withColumns({
        "review_date": F.date_format("review_date", "yyyy-MM-dd'T'HH:mm:ss"), "processed": F.lit(False),
    })
    return ingest.clean(texts, "reviews").select("review_id", "review_date", "scraped_at", "rating")


@query("products")
def ingest_rows(spark, products):
    """The rows that come out of an ingest, kept and rejected, each with its score."""
    folder = scratch.new_folder(spark, "ingest")
    kept, rejected, _ = ingest.ingest_into(typed(products, "products"), "products", timestamp(AS_OF), folder)
    rows = kept.withColumn("status", F.lit("processed")).unionByName(rejected.withColumn("status", F.lit("failed")))
    return rounded(rows.select("product_id", "status", "overall_score"), "overall_score")


@query("products", "reviews", "pricing")
def processing_stats(spark, products, reviews, pricing):
    batches = []
    for entity, df, as_of in (
        ("products", products, AS_OF), ("reviews", reviews, AS_OF), ("pricing", pricing, PRICES_AS_OF)
    ):
        for part in (0, 1):
            rows = typed(df, entity).filter(F.col("ingest_seq") % 2 == part)
            batches.append(ingest.ingest_counts(rows, entity, timestamp(as_of)).select(
                F.lit(entity).alias("entity"), F.lit(part).alias("batch_id"), "status", "n",
                (timestamp(AS_OF) + F.make_dt_interval(days=F.lit(part))).alias("processed_at"),
            ))
    return ingest.processing_stats(checks._union(batches))


@query("breadcrumbs")
def categorize_products(spark, crumbs):
    return crumbs.select("row_id", text.category_of(F.col("breadcrumb")).alias("category"))


@query("breadcrumbs")
def stock_status(spark, crumbs):
    sizes = F.when(F.col("row_id") % 2 == 0, F.array()).otherwise(
        F.array(F.coalesce("stock_text", F.lit("")), F.when(F.col("row_id") % 3 == 0, "L Available").otherwise("XL"))
    )
    return crumbs.select(
        "row_id", text.in_stock_from_text(F.col("stock_text"), F.col("site")).alias("by_text"),
        text.in_stock_from_sizes(sizes).alias("by_sizes"),
    )


@query("links")
def product_url_filter(spark, links):
    return selection.product_urls(links).select("row_id", "site", "url")


@query("products")
def search_term_coverage(spark, products):
    daily = selection.term_coverage(products, TEST_TERMS).withColumn("schedule", F.lit("daily"))
    weekly = selection.term_coverage(products, TEST_TERMS, first_terms=None, first_categories=2)
    return daily.unionByName(weekly.withColumn("schedule", F.lit("weekly")))


@query("products", "pricing")
def stale_price_products(spark, products, pricing):
    return selection.stale_prices(products, pricing, timestamp(PRICES_AS_OF), 6)


@query("products", "reviews")
def few_review_products(spark, products, reviews):
    return selection.few_reviews(products, reviews, 3)


# --- views and aggregates ----------------------------------------------------------------------------------------


@query("products", "pricing")
def product_price_trends(spark, products, pricing):
    trends = views.product_price_trends(products, pricing, timestamp(PRICES_AS_OF))
    return rounded(trends, "discount_percentage", "price_change")


@query("products", "reviews")
def product_review_summary(spark, products, reviews):
    return rounded(views.product_review_summary(products, reviews), "avg_rating")


@query("products")
def daily_scraping_summary(spark, products):
    return rounded(
        views.daily_scraping_summary(products, timestamp(AS_OF)), "spec_completeness", "desc_completeness"
    )


AVERAGES = ("avg_overall_score", "avg_completeness", "avg_accuracy", "avg_consistency")


@query("products", "reviews", "pricing_2024")
def quality_summary(spark, products, reviews, pricing):
    return rounded(views.quality_summary(all_scores(products, reviews, pricing), timestamp(AS_OF)), *AVERAGES)


@query("products", "pricing_2024", "reviews")
def site_comparison(spark, products, pricing, reviews):
    compared = views.site_comparison(products, pricing, reviews, timestamp(AS_OF))
    return rounded(compared, "avg_current_price", "avg_discount", "avg_rating")


@query("products", "pricing_2024", "reviews")
def site_comparison_preagg(spark, products, pricing, reviews):
    compared = views.site_comparison(products, pricing, reviews, timestamp(AS_OF), fan_out=False)
    return rounded(compared, "avg_current_price", "avg_discount", "avg_rating")


# --- views over tables written by day, whose look-backs read only the days they need ---


def _stored(spark, **tables) -> list[DataFrame]:
    """The tables written by day, products and prices as the warehouse does, and read back."""
    root = scratch.new_folder(spark, "stored")
    for name, df in tables.items():
        if name == "scores":
            df.withColumn("dt", F.to_date("evaluated_at")).write.partitionBy("dt").parquet(f"{root}/{name}")
        else:
            warehouse.append(ingest.clean(df, name), f"{root}/{name}", name)
    return [warehouse.read(spark, f"{root}/{name}") for name in tables]


@query("products", "pricing")
def stored_price_trends(spark, products, pricing):
    stored = _stored(spark, products=products, pricing=pricing)
    return rounded(views.product_price_trends(*stored, timestamp(PRICES_AS_OF)), "discount_percentage", "price_change")


@query("products")
def stored_daily_summary(spark, products):
    return rounded(views.daily_scraping_summary(*_stored(spark, products=products), timestamp(AS_OF)), "spec_completeness", "desc_completeness")


@query("products", "reviews", "pricing_2024")
def stored_quality_summary(spark, products, reviews, pricing):
    scores = all_scores(products, reviews, pricing).drop("issues")
    return rounded(views.quality_summary(*_stored(spark, scores=scores), timestamp(AS_OF)), *AVERAGES)


@query("products", "pricing_2024", "reviews")
def stored_site_comparison(spark, products, pricing, reviews):
    stored = _stored(spark, products=products, pricing=pricing, reviews=reviews)
    return rounded(views.site_comparison(*stored, timestamp(AS_OF)), "avg_current_price", "avg_discount", "avg_rating")


@query("offer_texts")
def offer_keyword_hits(spark, offers):
    spans = F.array("a", "b", "c", "d")
    return offers.select(
        "row_id", F.array_join(text.keyword_offers(spans), "|").alias("by_keyword"),
        F.array_join(text.long_offers(spans), "|").alias("by_length"),
    )


CHECK_AVERAGES = ("low_quality_rate", "avg_overall_score", "avg_completeness_score", "avg_accuracy_score",
                  "avg_consistency_score")


@query("products", "reviews", "pricing_2024")
def check_data_quality(spark, products, reviews, pricing):
    return rounded(checks.data_quality(all_scores(products, reviews, pricing)), *CHECK_AVERAGES)


def _tables(products, reviews, pricing) -> dict[str, DataFrame]:
    return {"products": products, "reviews": reviews, "pricing": pricing}


@query("products", "reviews", "pricing_2024")
def check_completeness(spark, *tables):
    return rounded(checks.completeness(checks.profiles(_tables(*tables), timestamp(AS_OF))), "avg_completeness")


@query("products", "reviews", "pricing_2024")
def check_freshness(spark, *tables):
    return rounded(checks.freshness(checks.profiles(_tables(*tables), timestamp(AS_OF))), "freshness_rate")


@query("products", "reviews", "pricing_2024")
def check_duplicate_rate(spark, *tables):
    return rounded(checks.duplicate_rate(_tables(*tables), timestamp(AS_OF)), "duplicate_rate")


@query("products", "reviews", "pricing_gap")
def check_site_coverage(spark, *tables):
    return checks.site_coverage(checks.profiles(_tables(*tables), timestamp(AS_OF)))


@query("pricing_gap")
def missing_sites(spark, pricing):
    return checks.missing_sites(pricing)


@query("jobs_2024")
def check_processing_health(spark, jobs):
    return rounded(checks.processing_health(jobs, timestamp(AS_OF)), "job_success_rate")


@query("jobs")
def job_status_counts(spark, jobs):
    return checks.job_status_counts(jobs)


def _all_checks(products, reviews, pricing, jobs) -> tuple[DataFrame, DataFrame]:
    as_of = timestamp(AS_OF)
    profile = checks.profiles(_tables(products, reviews, pricing), as_of, whole=True)
    return checks.run_checks(profile, jobs, as_of), profile


CHECKED = ("products", "reviews", "pricing_2024", "jobs_2024")


@query(*CHECKED)
def health_metrics(spark, *tables):
    found, profile = _all_checks(*tables)
    return rounded(checks.health_metrics(found, checks.average_quality(profile)), "overall_health_score", "avg_quality_score")


@query(*CHECKED)
def quality_alerts(spark, *tables):
    return checks.quality_alerts(_all_checks(*tables)[0])


@query(*CHECKED)
def overall_status(spark, *tables):
    return checks.overall_status(checks.quality_alerts(_all_checks(*tables)[0]))


@query(*CHECKED)
def quality_report_rows(spark, *tables):
    found = _all_checks(*tables)[0]
    folder = scratch.new_folder(spark, "report")
    export.write_csv(checks.report_rows(found, checks.quality_alerts(found)), folder)
    return spark.read.option("header", True).option("escape", '"').option("emptyValue", "").schema(
        "check_type string, status string, details string"
    ).csv(folder)


# --- metrics and alerts ------------------------------------------------------------------------------------------


@query("metrics")
def metric_counters(spark, samples):
    return rounded(metrics.counters(labelled(samples)), "value")


@query("metrics")
def metric_gauges(spark, samples):
    return rounded(metrics.gauges(labelled(samples)), "value")


@query("metrics")
def metric_timer_stats(spark, samples):
    return rounded(metrics.timer_stats(labelled(samples)), "avg", "min", "max", "p95")


@query("metrics")
def metrics_summary(spark, samples):
    return rounded(metrics.summary(labelled(samples)), "value")


@query("products", "reviews", "pricing_2024")
def quality_gauges(spark, *tables):
    return rounded(metrics.quality_gauges(all_scores(*tables)), "value")


@query("metrics")
def alerts_active(spark, samples):
    custom = {"busy": {"metric": "error_rate", "threshold": 0, "operator": "!=", "severity": "LOW", "message": "Errors"}}
    gauges = metrics.gauges(unlabelled(samples))
    return rounded(alerts.active(gauges, alerts.rules_frame(spark, custom)), "current_value")


def _episodes(spark, samples):
    return alerts.history(samples, alerts.rules_frame(spark))


@query("metrics")
def alert_history(spark, samples):
    return rounded(_episodes(spark, samples), "current_value")


@query("metrics")
def recent_alerts(spark, samples):
    return rounded(alerts.recent(_episodes(spark, samples), 100), "current_value")


@query("metrics")
def alert_summary(spark, samples):
    return alerts.summary(_episodes(spark, samples))


# --- reports -----------------------------------------------------------------------------------------------------

REPORTED = ("products", "reviews", "pricing_2024", "jobs_2024", "metrics")


def _daily(spark, products, reviews, pricing, jobs, samples):
    scores = all_scores(products, reviews, pricing)
    costs = reports.cost_report(reports.monthly_usage({"pricing": (pricing, "price_date")}, jobs), RATES, BUDGET)
    return reports.daily_report(
        products, reviews, pricing, jobs, scores, samples, _episodes(spark, samples), costs,
        F.lit("2024-01-20").cast("date"),
    )


@query(*REPORTED)
def daily_report(spark, *tables):
    return rounded(_daily(spark, *tables), "value")


@query(*REPORTED)
def report_csv_rows(spark, *tables):
    folder = scratch.new_folder(spark, "report")
    report = _daily(spark, *tables)
    export.write_report(report, f"{folder}/json")
    export.write_csv(reports.flattened(report), f"{folder}/csv")
    back = spark.read.option("header", True).schema("metric string, value double, category string").csv(f"{folder}/csv")
    return back


def _weekly(products, reviews, pricing):
    end = timestamp(AS_OF)
    return {
        "products": (products, "scraped_at", end), "reviews": (reviews, "scraped_at", end),
        "pricing": (pricing, "price_date", end),
    }


@query("products", "reviews", "pricing_2024", "jobs_2024")
def weekly_summary(spark, products, reviews, pricing, jobs):
    end = timestamp(AS_OF)
    scores = all_scores(products, reviews, pricing)
    return rounded(reports.weekly_summary(_weekly(products, reviews, pricing), scores, jobs, end, end), "value")


@query("products", "reviews", "pricing_2024")
def weekly_growth(spark, *tables):
    return rounded(reports.weekly_growth(_weekly(*tables)), "growth_percentage")


@query(*REPORTED)
def weekly_trends(spark, products, reviews, pricing, jobs, samples):
    end = timestamp(AS_OF)
    trends = reports.weekly_trends(
        pricing, all_scores(products, reviews, pricing), samples, jobs, end, end, timestamp(METRICS_AS_OF), end
    )
    return rounded(trends, "current_value", "previous_value")


@query("products", "jobs")
def top_performing_sites(spark, products, jobs):
    scored = quality.with_scores(typed(products, "products"), "products", timestamp(AS_OF))
    ranked = reports.top_sites(products, jobs, scored).withColumn("rank", F.col("rank").cast("long"))
    return rounded(ranked, "success_rate", "avg_quality_score")


@query("metrics")
def recommendations(spark, samples):
    return reports.recommendations(metrics.gauges(unlabelled(samples)))


@query("pricing", "jobs")
def cost_report(spark, pricing, jobs):
    usage = reports.monthly_usage({"pricing": (pricing, "price_date")}, jobs)
    return rounded(reports.cost_report(usage, RATES, BUDGET), "utilization_percentage")


@query("products", "reviews", "pricing")
def storage_costs(spark, products, reviews, pricing):
    """Costs of all stored tables by the bytes of their files: the figures that don't hang on how files are packed."""
    root = scratch.new_folder(spark, "stored")
    folders = {}
    for name, df in (("products", products), ("reviews", reviews), ("pricing", pricing)):
        folders[name] = f"{root}/{name}"
        warehouse.append(ingest.clean(df, name), folders[name], name)
    costs = reports.storage_cost(reports.stored_bytes(spark, folders), RATES["storage_per_gigabyte"], BUDGET)
    rows = checks._union([warehouse.read(spark, path).agg(F.lit(name).alias("table"), F.count("*").alias("rows")) for name, path in folders.items()])
    return rounded(costs, "share").join(rows, "table").select(
        "table", "rows", (F.col("bytes") > 8 * F.col("rows")).alias("measured"), (F.col("share") > 0).alias("has_share"),
        (F.floor(F.col("cost") / F.col("bytes") * 1e13 + 0.5) / 1e4).alias("cost_per_gigabyte"),
        (F.col("remaining_budget") < BUDGET).alias("charged"),
    )


@query(*REPORTED)
def dashboard_rows(spark, products, reviews, pricing, jobs, samples):
    board = reports.dashboard(
        unlabelled(samples), jobs, all_scores(products, reviews, pricing), _episodes(spark, samples),
        F.lit("2024-01-20").cast("date"),
    )
    return rounded(board, "value")


# --- windows, top-k, batches, duplicates -------------------------------------------------------------------------


@query("reviews")
def top_reviews_per_product(spark, reviews):
    order = [F.desc("rating"), F.desc("scraped_at"), "ingest_seq"]
    return dedup.top_rows(reviews, ["product_id"], order, 20).select(
        "product_id", F.col("rank").cast("long").alias("rank"), "review_id", "rating"
    )


@query("offer_texts")
def array_topk(spark, offers):
    spans = F.array("a", "c", "a", "d", "b", "c")
    return offers.select(
        "row_id", F.array_join(text.array_top(spans, 5), "|").alias("top_five"),
        F.array_join(text.array_top(spans, 3), "|").alias("top_three"),
    )


@query("products")
def batch_assign(spark, products):
    batched = selection.assign_batches(products, "site", size=100)
    return batched.groupBy("site", "batch").agg(
        F.count("*").alias("rows"), F.min("ingest_seq").alias("first_seq"), F.max("ingest_seq").alias("last_seq")
    )


@query("pricing")
def dedup_across_batches(spark, pricing):
    early = pricing.filter("ingest_seq % 2 = 0")
    seen = dedup.drop_duplicates(early, "pricing").select(dedup.signature_hash("pricing").alias("signature"))
    return dedup.drop_seen(pricing.filter("ingest_seq % 2 = 1"), seen, "pricing").select("price_id", "ingest_seq")


# --- text, URLs, prices, dates -----------------------------------------------------------------------------------


@query("products")
def url_validity(spark, products):
    odd = F.when(F.col("ingest_seq") % 9 == 0, "http://localhost:8080/x").when(
        F.col("ingest_seq") % 9 == 1, "https://10.0.0.1").when(F.col("ingest_seq") % 9 == 2, "https://nodots/path").when(
        F.col("ingest_seq") % 9 == 3, "").when(F.col("ingest_seq") % 9 == 4, "https://a.example.com/with space")
    url = F.coalesce(odd, "url")
    return products.select("product_id", url.alias("url"), text.is_valid_url(url).alias("valid"))


@query("reviews")
def spam_flags(spark, reviews):
    return text.with_spam_checks(reviews, "content").select("ingest_seq", *text.SPAM_CHECKS, "meaningful")


@query("products", "reviews", "pricing_2024")
def issue_counts(spark, *tables):
    issues = all_scores(*tables).select("record_type", F.explode("issues").alias("issue"))
    return issues.groupBy("record_type", "issue").agg(F.count("*").alias("rows"))


@query("price_texts")
def parse_prices(spark, prices):
    shown = F.col("price_text")
    return prices.select(
        "row_id", "line", text.clean_price(shown).alias("price"), text.price_from_text(shown).alias("loose_price")
    )


@query("pricing")
def first_price(spark, pricing):
    seq = F.col("ingest_seq")
    candidates = [
        F.when(seq % 3 == 0, 0.0), F.when(seq % 2 == 0, F.col("current_price")), F.col("original_price")
    ]
    return pricing.select("ingest_seq", text.first_price(*candidates).alias("price")).filter("price is not null")


@query("pricing")
def discounts(spark, pricing):
    current, original, seq = F.col("current_price"), F.col("original_price"), F.col("ingest_seq")
    stated = F.when(seq % 3 == 0, 0.0).when(seq % 3 == 1, F.col("discount_percentage"))
    return rounded(
        pricing.select(
            "ingest_seq", text.discount_amount(current, original).alias("amount"),
            text.discount_percentage(current, original, stated).alias("percentage"),
        ),
        "amount", "percentage",
    )


@query("products", "reviews", "pricing")
def record_ids(spark, products, reviews, pricing):
    seq = F.col("ingest_seq")
    return (
        products.select(
            F.lit("product").alias("kind"), seq, text.product_key(*map(F.col, ("site", "url", "name"))).alias("key"))
        .unionByName(reviews.select(
            F.lit("review").alias("kind"), seq,
            text.review_key(*map(F.col, ("product_id", "content", "reviewer_name"))).alias("key")))
        .unionByName(pricing.select(
            F.lit("price").alias("kind"), seq, text.price_key(F.col("product_id"), F.col("scraped_at")).alias("key")))
    )


@query("reviews")
def anonymize_reviewers(spark, reviews):
    short = F.when(F.col("ingest_seq") % 10 == 1, "Al").otherwise(F.col("reviewer_name"))
    return reviews.select("ingest_seq", text.mask_name(short).alias("reviewer"))


@query("documents")
def clean_text(spark, documents):
    cleaned = text.clean_text(F.col("text"))
    return documents.select("doc_id", F.length(cleaned).cast("long").alias("length"), F.md5(cleaned).alias("digest"))


@query("links")
def normalize_urls(spark, links):
    base = F.lit("https://www.shop.example.com/list/page.html")
    return links.select("row_id", text.strip_tracking(text.absolute_url(F.col("url"), base)).alias("url"))


@query("pages")
def pages_by_domain(spark, pages_):
    return pages_.groupBy(text.domain(F.col("url")).alias("domain")).agg(F.count("*").alias("pages"))


@query("date_texts")
def parse_review_dates(spark, dates):
    return dates.select("row_id", "site", text.review_date(F.col("date_text"), F.col("site")).alias("review_date"))


@query("reviews")
def parse_ratings(spark, reviews):
    shown = F.when(F.col("ingest_seq") % 6 == 0, "no stars").otherwise(
        F.concat(F.col("rating").cast("string"), F.lit(" out of 5 stars")))
    css = F.when(F.col("ingest_seq") % 4 == 0, "a-icon").otherwise(
        F.concat(F.lit("a-icon a-star-"), (F.col("ingest_seq") % 5 + 1).cast("string")))
    return reviews.select(
        "ingest_seq", text.rating_from_text(shown).alias("by_text"), text.rating_from_class(css).alias("by_class")
    )


@query("links")
def url_keys(spark, links):
    byline = F.concat(F.lit("Visit the "), "site", F.lit(" Store"))
    image = F.concat(F.lit("https://img.example.com/w_200/"), F.col("row_id").cast("string"))
    return links.select(
        "row_id", text.listing_number(F.col("url")).alias("item_code"), text.brand_from_byline(byline).alias("brand"),
        text.larger_image(image).alias("image"),
    )


@query("metrics")
def label_keys(spark, samples):
    labels = F.create_map(F.lit("type"), F.col("type"), F.lit("site"), F.col("site_label"))
    return samples.select("seq", text.label_key(F.col("name"), F.when(F.col("seq") % 4 != 0, labels)).alias("key"))


# --- pages -------------------------------------------------------------------------------------------------------


@query("pages")
def html_element_counts(spark, pages_):
    return html.element_rows(pages_).groupBy("tag").agg(
        F.count("*").alias("elements"), F.count_distinct("page_id").alias("pages")
    )


@query("shop_pages", "pages")
def extract_products(spark, shop, pages_):
    plain = pages_.select((F.col("page_id") + 2_000_000_000).alias("page_id"), F.lit("generic").alias("site"), "url", "html")
    both = shop.select("page_id", "site", "url", "html").unionByName(plain)
    return pages.extract_products(both).select(
        "page_id", "product_id", "site", "name", "category", "brand", "url",
        F.when(F.col("site") != "generic", F.col("description")).alias("description"),
        F.array_join(F.map_values("specifications"), "|").alias("specifications"),
        F.array_join("images", "|").alias("images"), "in_stock",
    )


@query("review_pages")
def extract_reviews(spark, shop):
    return pages.extract_reviews(shop).select(
        "page_id", "position", "review_id", "product_id", "site", F.md5("content").alias("content_digest"), "rating",
        "reviewer_name", "verified_purchase", "review_date",
    )


@query("review_pages", "shop_pages")
def linked_reviews(spark, review_pages, shop_pages):
    """Reviews of the first shop, which carry item codes, joined to the products that have these codes."""
    reviews = pages.extract_reviews(review_pages.filter("site = 'amazon'"))
    products = pages.extract_products(shop_pages.filter("site = 'amazon'").select("page_id", "site", "url", "html"))
    linked = pages.link_item_codes(reviews, products).join(products.select("product_id", "name"), "product_id", "left")
    return linked.groupBy("product_id", "name").agg(F.count("*").alias("reviews"), F.sum("rating").alias("rating_sum"))


@query("listing_pages")
def shop_listings(spark, shop):
    """Cards of the three shops' result pages with all of their fields."""
    return pages.extract_listings(shop).select("page_id", "position", "site", "url", "name", "price", "rating", "image")


@query("shop_pages")
def extract_pricing(spark, shop):
    prices = pages.extract_pricing(shop).withColumn("offers", F.array_join("offers", "|"))
    return rounded(prices, "discount_percentage", "discount_amount")


@query("pages")
def extract_listings(spark, pages_):
    listed = pages.extract_listings(pages_.withColumn("site", F.lit("generic")))
    return listed.select("page_id", "position", "url", "name")


# --- streams and activity ----------------------------------------------------------------------------------------


@query("fetch_log")
def stale_gaps(spark, log):
    return activity.stale_gaps(log, "user_id", timestamp(METRICS_AS_OF))


@query("fetch_log")
def politeness_audit(spark, log):
    return activity.politeness_audit(log)


def stream_query(table: str, binding: str):
    """Register a streaming query: the table arrives as a stream, through the same binding."""
    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            bindings.load(spark, sf_dir, *[t for t in bindings.tables_of(binding) if t != table])
            streams.read_table(spark, sf_dir, table).createOrReplaceTempView(table)
            return build(spark, bindings.bound(spark, binding), scratch.new_folder(spark, "stream"))

        QUERIES[build.__name__] = run
        return build

    return register


@stream_query("lineitem", "pricing")
def stream_ingest(spark, pricing, folder):
    typed_prices = typed(pricing, "pricing")
    version = ["ingest_seq", "product_id", "current_price"]
    kept, _ = streams.ingest(
        typed_prices, "pricing", timestamp(PRICES_AS_OF), f"{folder}/out", f"{folder}/checkpoint", version
    )
    return rounded(kept.select("price_id", "product_id", "current_price", "ingest_seq"), "current_price")


@stream_query("events", "fetch_log")
def stream_dedup(spark, log, folder):
    first = streams.first_within(log.select("ts", "user_id", "seq"), ["user_id"], "ts", "100 days", ["ts", "seq"])
    return bindings.zone_free(streams.run_to_end(first, f"{folder}/out", f"{folder}/checkpoint")).select("user_id", "ts", "seq")


@stream_query("events", "metrics")
def stream_metric_windows(spark, samples, folder):
    rows = streams.run_to_end(streams.metric_windows(samples), f"{folder}/out", f"{folder}/checkpoint")
    return rounded(bindings.zone_free(rows), "counter_sum", "gauge_last", "timer_min", "timer_max")


@stream_query("events", "fetch_log")
def stream_stale_users(spark, log, folder):
    rows = streams.run_to_end(streams.active_spells(log, "user_id"), f"{folder}/out", f"{folder}/checkpoint")
    return bindings.zone_free(rows)


@stream_query("events", "fetch_log")
def stream_silence_alerts(spark, log, folder):
    with silence.keyed_state(spark):
        rows = streams.run_to_end(silence.silence_alerts(log, "user_id"), f"{folder}/out", f"{folder}/checkpoint")
    return bindings.zone_free(rows)


@stream_query("lineitem", "pricing")
def stream_ingest_counts(spark, pricing, folder):
    counts = streams.ingest_counts(typed(pricing, "pricing"), "pricing", timestamp(PRICES_AS_OF), f"{folder}/out", f"{folder}/checkpoint")
    return counts.groupBy("entity").agg(*[F.sum(c).alias(c) for c in ("rows", "processed", "duplicates", "failures")])


@stream_query("events", "metrics")
def stream_timer_windows(spark, samples, folder):
    with silence.keyed_state(spark):
        rows = streams.run_to_end(timers.timer_windows(samples), f"{folder}/out", f"{folder}/checkpoint")
    return rounded(bindings.zone_free(rows), "avg", "min", "max", "p95")
