"""Staging tables as append-only logs of row versions, and the ledger of versions already loaded.

A write appends rows with a rising `ingest_seq`; a read keeps each key's latest version. Nothing is rewritten in
place, so a write costs its own batch only. The ledger holds (key, ingest_seq): a replaced row is a new version and
therefore unprocessed again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.operators import dedup
from stallwise.plans.views import days_before


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_or_empty(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A table's rows with the columns of `like`; no rows while the table has not been written."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return like.limit(0)


def current(versions: DataFrame, key: str) -> DataFrame:
    return dedup.latest_rows(versions, key)


def pending(latest: DataFrame, ledger: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Row versions that are not in the ledger; with a limit, the first ones by key."""
    rows = latest.join(ledger.select(key, "ingest_seq"), [key, "ingest_seq"], "left_anti")
    return rows if limit is None else rows.orderBy(key).limit(limit)


def marks(rows: DataFrame, key: str) -> DataFrame:
    """Ledger entries for loaded rows."""
    return rows.select(key, "ingest_seq")


def with_processed(latest: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    done = ledger.select(key, "ingest_seq", F.lit(True).alias("processed")).distinct()
    return latest.join(done, [key, "ingest_seq"], "left").fillna(False, ["processed"])


def expired(as_of: Column, days: int) -> Column:
    return F.col("processed") & F.coalesce(F.col("scraped_at") < days_before(as_of, days), F.lit(False))


def retained(latest: DataFrame, ledger: DataFrame, key: str, as_of: Column, days: int = 30) -> DataFrame:
    """Rows to keep: all but those that are loaded and older than `days`."""
    return with_processed(latest, ledger, key).filter(~expired(as_of, days))


def retention_counts(latest: DataFrame, ledger: DataFrame, key: str, as_of: Column, days: int = 30) -> DataFrame:
    """(kept, dropped): how many rows `retained` keeps and leaves out."""
    old = expired(as_of, days)
    return with_processed(latest, ledger, key).agg(F.count_if(~old).alias("kept"), F.count_if(old).alias("dropped"))


def compact(rows: DataFrame, new_path: str, key: str, max_records_per_file: int = 5_000_000) -> None:
    """Write the latest versions (or the retained ones) to a new folder, which then takes the log's place."""
    current(rows, key).write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).parquet(new_path)
