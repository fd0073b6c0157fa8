"""Daily, weekly and cost reports and the dashboard, all measured from the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.operators import alerts as alert_ops
from stallwise.operators import dedup
from stallwise.operators import metrics as metric_ops
from stallwise.plans.views import days_before, exact_avg, stored_by_day_of, within


def _section(df: DataFrame, section: str) -> DataFrame:
    """A one-row frame of figures as rows (section, metric, value)."""
    figures = df.select(*[F.col(c).cast("double").alias(c) for c in df.columns])
    return figures.unpivot([], df.columns, "metric", "value").select(F.lit(section).alias("section"), "metric", "value")


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _on(c: str, day: Column, table: DataFrame | None = None) -> Column:
    """Rows of a day; of a table written by that day only its partition is read."""
    inside = F.to_date(c) == day
    return inside & (F.col("dt") == day) if table is not None and stored_by_day_of(table, c) else inside


def _status(name: str) -> Column:
    return F.count_if(F.col("status") == name)


def _success(scale: int = 100) -> Column:
    return _status("completed") / F.nullif(_status("completed") + _status("failed"), F.lit(0)) * scale


def daily_report(
    products: DataFrame, reviews: DataFrame, pricing: DataFrame, jobs: DataFrame, scores: DataFrame,
    samples: DataFrame, episodes: DataFrame, costs: DataFrame, day: Column,
) -> DataFrame:
    """Figures of one day as rows (section, metric, value). `costs` are the monthly ones of `cost_report`."""
    scraped = products.filter(_on("scraped_at", day, products)).agg(
        F.count("*").alias("total_products_scraped"), F.countDistinct("site").alias("sites_scraped"),
        F.countDistinct("category").alias("categories_covered"),
    )
    seen = reviews.filter(_on("scraped_at", day, reviews)).agg(F.count("*").alias("total_reviews_scraped"))
    priced = pricing.filter(_on("scraped_at", day, pricing)).agg(F.count("*").alias("total_pricing_updates"))
    worked = jobs.filter(_on("created_at", day, jobs)).agg(
        _status("completed").alias("jobs_completed"), _status("failed").alias("jobs_failed"),
        _success().alias("success_rate_percentage"),
    )
    overall = F.col("overall_score")
    judged = scores.filter(_on("evaluated_at", day, scores)).agg(
        exact_avg("overall_score").alias("avg_quality_score"),
        F.count_if(overall >= 0.8).alias("high_quality_records"),
        F.count_if((overall >= 0.5) & (overall < 0.8)).alias("medium_quality_records"),
        F.count_if(overall < 0.5).alias("low_quality_records"),
        (F.count_if(overall < schemas.MIN_OVERALL_SCORE) / F.nullif(F.count("*"), F.lit(0)) * 100).alias(
            "validation_failure_rate"),
    )
    fresh = products.filter(_on("scraped_at", day, products)).withColumn("signature", dedup.signature_hash("products"))
    repeated = fresh.agg(
        ((F.count("*") - F.countDistinct("signature")) / F.nullif(F.count("*"), F.lit(0)) * 100).alias(
            "duplicate_rate_percentage")
    )
    that_day = samples.filter(_on("ts", day, samples)).drop("labels")

    def read(key: str, c: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("key") == key, F.col(c))), F.lit(0))

    timed = metric_ops.timer_stats(that_day).agg(
        read("request_latency", "avg").alias("avg_request_latency_seconds"),
        read("request_latency", "p95").alias("p95_request_latency"),
        read("request_latency", "count").alias("total_requests"),
        read("processing_time", "avg").alias("avg_processing_time_seconds"),
    )
    loaded = metric_ops.gauges(that_day).agg(
        read("memory_usage", "value").alias("memory_usage_mb"),
        read("cpu_usage_percentage", "value").alias("cpu_usage_percentage"),
    )
    today = _on("started_at", day)
    end = F.date_add(day, 1).cast("timestamp_ntz")
    open_then = (F.col("started_at") < end) & (F.col("resolved_at").isNull() | (F.col("resolved_at") >= end))
    alerted = episodes.agg(
        F.count_if(open_then).alias("active_alerts_count"), F.count_if(today).alias("total_alerts_today"),
        F.count_if(today & (F.col("severity") == "HIGH")).alias("high_severity_alerts"),
        F.count_if(today & (F.col("severity") == "MEDIUM")).alias("medium_severity_alerts"),
        F.count_if(today & F.col("resolved_at").isNotNull()).alias("resolved_alerts"),
    )
    month = costs.filter(F.col("month") == F.trunc(day, "month"))
    daily = {c: f"daily_{c}" for c in ("storage_cost", "query_cost", "compute_cost", "total_cost")}
    spent = month.agg(*[(F.coalesce(F.sum(c), F.lit(0.0)) / 30).alias(alias) for c, alias in daily.items()])
    sections = {
        "Scraping": (scraped, seen, priced, worked), "Quality": (judged, repeated), "Performance": (timed, loaded),
        "Alerts": (alerted,), "Costs": (spent,),
    }
    return _union([_section(df, name) for name, frames in sections.items() for df in frames])


def _weeks(c: str, end: Column) -> Column:
    """'current' for the seven days before `end`, 'previous' for the seven before those, else NULL."""
    return F.when((F.col(c) >= days_before(end, 7)) & (F.col(c) < end), "current").when(
        (F.col(c) >= days_before(end, 14)) & (F.col(c) < days_before(end, 7)), "previous"
    )


def _two_weeks(df: DataFrame, c: str, end: Column) -> DataFrame:
    return df.filter(within(df, c, days_before(end, 14), end)).withColumn("week", _weeks(c, end))


def _in(week: str) -> Column:
    return F.col("week") == week


def weekly_growth(tables: dict[str, tuple[DataFrame, str, Column]]) -> DataFrame:
    """Rows of the week and the week before per table `{name: (frame, time column, end)}`, with growth in percent."""
    def one(name: str, df: DataFrame, c: str, end: Column) -> DataFrame:
        return _two_weeks(df, c, end).agg(
            F.lit(name).alias("table"), F.count_if(_in("current")).alias("current_rows"),
            F.count_if(_in("previous")).alias("previous_rows"),
        )

    before = F.nullif("previous_rows", F.lit(0))
    growth = (F.col("current_rows") - F.col("previous_rows")) / before * 100
    return _union([one(n, *spec) for n, spec in tables.items()]).withColumn("growth_percentage", growth)


def weekly_summary(
    tables: dict[str, tuple[DataFrame, str, Column]], scores: DataFrame, jobs: DataFrame, end: Column, jobs_end: Column
) -> DataFrame:
    """Totals of the seven days before `end` as rows (metric, value)."""
    def during(df: DataFrame, c: str, until: Column) -> DataFrame:
        return df.filter(within(df, c, days_before(until, 7), until))

    totals = [
        _section(during(df, c, until).agg(F.count("*").alias(f"total_{name}")), "Summary")
        for name, (df, c, until) in tables.items()
    ]
    judged = during(scores, "evaluated_at", end).agg(exact_avg("overall_score").alias("avg_quality_score"))
    uptime = during(jobs, "created_at", jobs_end).agg(_success().alias("uptime_percentage"))
    return _union([*totals, _section(judged, "Summary"), _section(uptime, "Summary")]).drop("section")


def weekly_trends(
    pricing: DataFrame, scores: DataFrame, samples: DataFrame, jobs: DataFrame, end: Column, prices_end: Column,
    metrics_end: Column, jobs_end: Column,
) -> DataFrame:
    """Trend words of volume, quality, latency and failures: this week's figure against the week before."""
    def compared(df: DataFrame, c: str, until: Column, metrics: dict[str, callable]) -> DataFrame:
        figures = _two_weeks(df, c, until).agg(*[
            F.struct(
                F.lit(name).alias("metric"), figure("current").cast("double").alias("current_value"),
                figure("previous").cast("double").alias("previous_value"),
            ).alias(name)
            for name, figure in metrics.items()
        ])
        return figures.select(F.inline(F.array(*metrics)))

    def mean(c: str):
        return lambda week: exact_avg(F.when(_in(week), F.col(c)))

    def failure_rate(week: str) -> Column:
        failed = F.count_if(_in(week) & (F.col("status") == "failed"))
        finished = F.count_if(_in(week) & F.col("status").isin("completed", "failed"))
        return failed / F.nullif(finished, F.lit(0)) * 100

    parts = [
        compared(pricing, "price_date", prices_end, {"scraping_volume": lambda week: F.count_if(_in(week))}),
        compared(scores, "evaluated_at", end, {
            f"{part}_quality": mean(f"{part}_score")
            for part in ("overall", "completeness", "accuracy", "consistency")
        }),
        compared(samples.filter("type = 'timer'"), "ts", metrics_end, {"latency": mean("value")}),
        compared(jobs, "created_at", jobs_end, {"error_rate": failure_rate}),
    ]
    change = (F.col("current_value") - F.col("previous_value")) / F.nullif("previous_value", F.lit(0.0)) * 100
    better = F.when(F.col("metric").endswith("_quality"), "improving").otherwise("increasing")
    trend = F.when(change > 1, better).when(change < -1, "decreasing").otherwise("stable")
    return _union(parts).withColumn("trend", trend)


def top_sites(products: DataFrame, jobs: DataFrame, product_scores: DataFrame) -> DataFrame:
    """Sites ranked by job success, then quality, products and name. `product_scores` carries the site."""
    success = jobs.groupBy("site").agg(_success().alias("success_rate"))
    quality = product_scores.groupBy("site").agg(exact_avg("overall_score").alias("avg_quality_score"))
    volume = products.groupBy("site").agg(F.countDistinct("product_id").alias("total_products"))
    figures = volume.join(success, "site", "left").join(quality, "site", "left")
    # One row per site by now.
    best = W.orderBy(F.desc("success_rate"), F.desc("avg_quality_score"), F.desc("total_products"), "site")
    return figures.withColumn("rank", F.rank().over(best))


def recommendations(gauges: DataFrame) -> DataFrame:
    """Advice for the gauges (key, value) that call for it; a gauge without samples reads 0.0."""
    quality, memory = (
        F.coalesce(F.max(F.when(F.col("key") == k, F.col("value"))), F.lit(0.0))
        for k in ("data_quality_score", "memory_usage_percentage")
    )
    advice = F.array_compact(F.array(
        F.when(quality < 0.8, "Consider implementing additional data validation rules"),
        F.when(memory > 80, "Monitor memory usage - consider optimizing batch sizes"),
    ))
    return gauges.agg(advice.alias("advice")).select(F.explode("advice").alias("recommendation"))


def monthly_usage(stored: dict[str, tuple[DataFrame, str]], jobs: DataFrame) -> DataFrame:
    """Rows stored, rows queried and jobs run per month, from the tables `{name: (frame, time column)}`."""
    def month(c: str) -> Column:
        return F.date_trunc("month", F.col(c)).cast("date").alias("month")

    rows = [
        df.groupBy(month(c)).agg(F.count("*").alias("stored_rows")).withColumn("jobs", F.lit(0).cast("long"))
        for df, c in stored.values()
    ]
    runs = jobs.groupBy(month("created_at")).agg(F.count("*").alias("jobs")).withColumn(
        "stored_rows", F.lit(0).cast("long")
    )
    return _union([*rows, runs]).groupBy("month").agg(
        F.sum("stored_rows").alias("stored_rows"), F.sum("jobs").alias("jobs")
    )


def stored_bytes(spark: SparkSession, folders: dict[str, str]) -> DataFrame:
    """(table, files, bytes) of stored tables `{name: folder}`: from the listing of their files, no row or byte is read."""
    parts = [
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(folder)
        .agg(F.lit(name).alias("table"), F.count("path").alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        for name, folder in folders.items()
    ]
    return _union(parts)


def storage_cost(stored: DataFrame, per_gigabyte: float, budget: float) -> DataFrame:
    """Cost of each stored table by its bytes, its share of all, and what all of them leave of the budget."""
    cost = F.col("bytes") / F.lit(1e9) * per_gigabyte
    every = stored.agg(F.sum("bytes")).scalar()
    whole = every / F.lit(1e9) * per_gigabyte
    return stored.select(
        "table", "files", "bytes", cost.alias("cost"), (F.col("bytes") / F.nullif(every, F.lit(0))).alias("share"),
        (F.lit(budget) - whole).alias("remaining_budget"), (whole / budget * 100).alias("utilization_percentage"),
    )


def cost_report(usage: DataFrame, rates: dict[str, float], budget: float) -> DataFrame:
    """Cost per month: rate times measured quantity, against the budget."""
    storage = F.col("stored_rows") * rates["storage_per_row"]
    query = F.col("stored_rows") * rates["query_per_row"]
    compute = F.col("jobs") * rates["compute_per_job"]
    total = F.col("storage_cost") + F.col("query_cost") + F.col("compute_cost")
    return (
        usage.select("month", storage.alias("storage_cost"), query.alias("query_cost"), compute.alias("compute_cost"))
        .withColumn("total_cost", total)
        .withColumns({
            "remaining_budget": F.lit(budget) - F.col("total_cost"),
            "utilization_percentage": F.col("total_cost") / budget * 100,
        })
    )


def dashboard(samples: DataFrame, jobs: DataFrame, scores: DataFrame, episodes: DataFrame, day: Column) -> DataFrame:
    """Current figures as rows (section, metric, value)."""
    plain = samples.drop("labels")
    current = metric_ops.counters(plain).unionByName(metric_ops.gauges(plain)).select(
        F.lit("current_metrics").alias("section"), F.col("key").alias("metric"), "value"
    )
    latency = metric_ops.timer_stats(plain).select(
        F.lit("performance_indicators").alias("section"), F.concat(F.lit("avg_"), "key").alias("metric"),
        F.col("avg").alias("value"),
    )
    today = _on("created_at", day)
    status = jobs.agg(
        _status("running").alias("running_jobs"), _status("pending").alias("queued_jobs"),
        F.count_if(today & (F.col("status") == "completed")).alias("completed_today"),
        F.count_if(today & (F.col("status") == "failed")).alias("failed_today"),
    )
    quality = metric_ops.quality_gauges(scores).select(
        F.lit("quality_indicators").alias("section"), F.col("name").alias("metric"), "value"
    )
    recent = alert_ops.recent(episodes, 10).agg(
        F.count("*").alias("recent_alerts"), F.count_if(F.col("resolved_at").isNull()).alias("recent_unresolved")
    )
    return _union([current, latency, _section(status, "job_status"), quality, _section(recent, "recent_alerts")])


def flattened(report: DataFrame) -> DataFrame:
    """Report rows as (metric, value, category) with text values, the CSV form."""
    value = F.floor(F.col("value") * 10000 + 0.5) / 10000
    return report.select("metric", value.cast("string").alias("value"), F.col("section").alias("category"))
