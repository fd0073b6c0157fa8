"""Gaps in activity logs: stale users and impolite fetching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.operators import ordered


def _with_gap(log: DataFrame, key: str, partitions: int | None) -> DataFrame:
    slim = log.select(key, "ts", "seq")
    gapped = ordered.previous_values(slim, [key], ["ts", "seq"], {"ts": "previous_ts"}, partitions)
    return gapped.withColumn("gap_micros", ordered.micros(F.col("ts")) - ordered.micros(F.col("previous_ts")))


def stale_gaps(log: DataFrame, key: str, as_of: Column, hours: int = schemas.STALE_HOURS, partitions: int | None = None) -> DataFrame:
    """Times without any row for longer than `hours`, with the open one up to `as_of` (its end is NULL)."""
    longest = hours * 3_600_000_000
    closed = _with_gap(log, key, partitions).filter(F.col("gap_micros") > longest).select(
        key, F.col("previous_ts").alias("gap_start"), F.col("ts").alias("gap_end")
    )
    last = log.groupBy(key).agg(F.max("ts").alias("gap_start"))
    still_open = last.filter(ordered.micros(as_of) - ordered.micros(F.col("gap_start")) > longest).select(
        key, "gap_start", F.lit(None).cast("timestamp_ntz").alias("gap_end")
    )
    return closed.unionByName(still_open)


def politeness_audit(
    log: DataFrame, key: str = "domain", per_second: float = schemas.MAX_REQUESTS_PER_SECOND, partitions: int | None = None
) -> DataFrame:
    """Requests per domain that came too soon after the one before, and the smallest gap in seconds."""
    shortest = int(1_000_000 / per_second)
    return _with_gap(log, key, partitions).groupBy(key).agg(
        F.count("*").alias("requests"), F.count_if(F.col("gap_micros") < shortest).alias("too_soon"),
        (F.min("gap_micros") / 1_000_000).alias("smallest_gap"),
    )
