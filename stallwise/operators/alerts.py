"""Alert rules on gauges: which hold now, and the episodes they went through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.operators import ordered

RULE_FIELDS = ["metric", "threshold", "operator", "severity", "message"]


def rules_frame(spark: SparkSession, custom: dict[str, dict] | None = None) -> DataFrame:
    """Default rules and custom ones; a custom rule of a default's name replaces it. A short table from code."""
    rules = {r[0]: r for r in schemas.ALERT_RULES}
    for name, rule in (custom or {}).items():
        lacking = [f for f in RULE_FIELDS if f not in rule]
        if lacking:
            raise ValueError(f"Alert rule {name} lacks {lacking}")
        rules[name] = (name, *(float(rule[f]) if f == "threshold" else rule[f] for f in RULE_FIELDS))
    return spark.createDataFrame(
        list(rules.values()),
        "rule_name string, metric string, threshold double, operator string, severity string, message string",
    )


def holds(value: Column, threshold: Column, operator: Column) -> Column:
    tests = {
        ">": value > threshold, "<": value < threshold, ">=": value >= threshold, "<=": value <= threshold,
        "==": value == threshold, "!=": value != threshold,
    }
    chosen = None
    for symbol, test in tests.items():
        chosen = F.when(operator == symbol, test) if chosen is None else chosen.when(operator == symbol, test)
    return chosen.otherwise(False)


def active(gauges: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules that hold on the current gauges (key, value). A gauge without samples reads 0.0 and is marked."""
    current = gauges.withColumnsRenamed({"key": "metric", "value": "gauge"})
    value = F.coalesce("gauge", F.lit(0.0))
    return (
        rules.join(current, "metric", "left")
        .filter(holds(value, F.col("threshold"), F.col("operator")))
        .select(
            "rule_name", "metric", value.alias("current_value"), "threshold", "severity", "message",
            F.col("gauge").isNotNull().alias("has_data"),
        )
    )


def history(samples: DataFrame, rules: DataFrame, partitions: int | None = None) -> DataFrame:
    """Episodes per rule: from the first sample that meets it to the next that does not (NULL while it lasts).

    A handful of rules means every group is hot, so both looks along the samples are windows over ranges.
    """
    checked = (
        samples.filter("type = 'gauge'").select(F.col("name").alias("metric"), "ts", "seq", "value")
        .join(F.broadcast(rules), "metric")
        .withColumn("breach", holds(F.col("value"), F.col("threshold"), F.col("operator")))
        .select("rule_name", "metric", "severity", "ts", "seq", "value", "breach")
    )
    along = (["rule_name"], ["ts", "seq"])
    turns = ordered.previous_values(checked, *along, {"breach": "was"}, partitions).filter(
        F.col("breach") != F.coalesce("was", F.lit(False))
    ).drop("was")
    return (
        ordered.next_values(turns, *along, {"ts": "resolved_at"}, partitions).filter("breach")
        .select(
            "rule_name", "metric", "severity", F.col("value").alias("current_value"), F.col("ts").alias("started_at"),
            F.col("seq").alias("started_seq"), "resolved_at",
        )
    )


def recent(episodes: DataFrame, limit: int = 100) -> DataFrame:
    """The latest episodes: a top-k, each task keeps `limit` rows."""
    return episodes.orderBy(F.desc("started_at"), F.desc("started_seq"), "rule_name").limit(limit)


def summary(episodes: DataFrame) -> DataFrame:
    return episodes.groupBy(F.to_date("started_at").alias("day"), "severity").agg(
        F.count("*").alias("alerts"), F.count("resolved_at").alias("resolved")
    )
