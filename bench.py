"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the number of local threads. Each query runs twice into the
no-op sink, so all of its rows are made; the second run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from stallwise.plans import catalog
from stallwise.session import build

HEADLINE = [
    "ingest_products", "ingest_reviews", "ingest_pricing", "dedup_pricing", "score_pricing", "score_reviews",
    "constraint_violations", "upsert_pricing", "product_price_trends", "product_review_summary",
    "daily_scraping_summary", "quality_summary", "site_comparison", "check_data_quality", "overall_status",
    "metric_timer_stats", "alert_history", "politeness_audit", "parse_prices", "clean_text", "extract_products",
    "extract_listings", "daily_report",
]


def session(cpus: str) -> SparkSession:
    spark = build(
        "bench", spark__master=f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(timed(spark, name, sf_dir), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
