"""Counters, gauges and timers from metric samples (ts, seq, name, value, type, labels)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.functions import text
from stallwise.operators import dedup
from stallwise.plans.views import exact_avg, exact_sum, unsummable

TIMER_VALUES = 100


def keyed(samples: DataFrame) -> DataFrame:
    """Samples with their metric key: name and sorted labels."""
    labels = F.col("labels") if "labels" in samples.columns else F.lit(None).cast("map<string,string>")
    return samples.withColumn("key", text.label_key(F.col("name"), labels))


def counters(samples: DataFrame) -> DataFrame:
    return (
        keyed(samples.filter("type = 'counter'")).groupBy("key")
        .agg(exact_sum("value").alias("value"))
    )


def gauges(samples: DataFrame) -> DataFrame:
    return (
        keyed(samples.filter("type = 'gauge'")).groupBy("key")
        .agg(F.max_by("value", F.struct("ts", "seq")).alias("value"))
    )


def left_out(samples: DataFrame) -> DataFrame:
    """Per metric: samples that no sum or average can take (NaN, infinite, out of range)."""
    counted = keyed(samples).groupBy("type", "key").agg(unsummable("value").alias("left_out"))
    return counted.filter("left_out > 0")


def timer_stats(samples: DataFrame, kept: int = TIMER_VALUES) -> DataFrame:
    """Figures over the last `kept` values of each timer. Only `kept` rows per key and task reach the shuffle."""
    recent = dedup.top_rows(
        keyed(samples.filter("type = 'timer'")).select("key", "ts", "seq", "value"),
        ["key"], [F.desc("ts"), F.desc("seq")], kept,
    )
    ordered = F.array_sort(F.collect_list("value"))
    stats = recent.groupBy("key").agg(
        F.count("value").alias("count"), exact_avg("value").alias("avg"), F.min("value").alias("min"),
        F.max("value").alias("max"), ordered.alias("values"),
    )
    at = F.floor(F.col("count") * F.lit(0.95)).cast("int") + 1
    p95 = F.when(F.col("count") > 20, F.element_at("values", at)).otherwise(F.col("max"))
    return stats.withColumn("p95", p95).drop("values")


def summary(samples: DataFrame) -> DataFrame:
    """All metrics as rows (kind, key, stat, value)."""
    def rows(df: DataFrame, kind: str) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), "key", F.lit("value").alias("stat"), "value")

    timers = (
        timer_stats(samples).withColumn("count", F.col("count").cast("double"))
        .unpivot("key", ["count", "avg", "min", "max", "p95"], "stat", "value")
        .select(F.lit("timer").alias("kind"), "key", "stat", "value")
    )
    return rows(counters(samples), "counter").unionByName(rows(gauges(samples), "gauge")).unionByName(timers)


def recent(samples: DataFrame, limit: int = 1000) -> DataFrame:
    """The latest samples: a top-k, each task keeps `limit` rows."""
    return samples.orderBy(F.desc("ts"), F.desc("seq")).limit(limit)


def quality_gauges(scores: DataFrame) -> DataFrame:
    low = F.count_if(F.col("overall_score") < schemas.MIN_OVERALL_SCORE)
    return (
        scores.agg(
            exact_avg("overall_score").alias("data_quality_score"),
            (low / F.nullif(F.count("*"), F.lit(0)) * 100).alias("validation_failure_rate"),
        )
        .unpivot([], ["data_quality_score", "validation_failure_rate"], "name", "value")
        .filter("value is not null")
    )
