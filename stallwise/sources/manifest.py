"""The manifest of a table: one row for each staged batch, load and compaction, written when it is complete.

A folder without its row was never finished and is never read; the next attempt takes the same number and overwrites it.
So what a load reads and what a reader sees is decided by the manifest, not by listing or comparing rows. A table has one
writer at a time. The driver reads the manifest whole: a row per batch, whatever the batches hold.
"""

from __future__ import annotations

from pyspark.sql import Row, SparkSession

from stallwise.sources import staging

# kind: staged, load or base; upto: the last staged batch that a load holds, or the last load that a base holds.
SCHEMA = "number long, kind string, upto long, rows long"


def entries(spark: SparkSession, root: str, table: str) -> list[Row]:
    none = spark.createDataFrame([], SCHEMA)
    return staging.read_or_empty(spark, f"{root}/manifest/{table}", none).orderBy("number").collect()


def next_number(found: list[Row]) -> int:
    return 1 + max((e.number for e in found), default=0)


def commit(spark: SparkSession, root: str, table: str, number: int, kind: str, upto: int | None = None, rows: int | None = None) -> None:
    row = spark.createDataFrame([(number, kind, upto, rows)], SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{root}/manifest/{table}")


def mark(found: list[Row], kind: str) -> int:
    """The high-water mark: the last number that entries of `kind` hold (0: none)."""
    return max((e.upto for e in found if e.kind == kind), default=0)


def numbers(found: list[Row], kind: str, above: int = 0) -> list[int]:
    return [e.number for e in found if e.kind == kind and e.number > above]
