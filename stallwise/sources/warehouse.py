"""Day-partitioned warehouse tables, append loads and the incremental load from staging.

Staged batches and loads are numbered folders with a manifest. A load reads the staged batches above the high-water mark
and nothing else, and writes them as one more delta; its cost is that of the new batches. Readers merge on read: a base,
in which each key is unique, under the deltas loaded since. Compaction writes a new base now and then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.operators import dedup, ingest
from stallwise.sources import manifest, observed

DAY = "dt"


# A task sorts and writes about so many rows at most, which its memory holds.
ROWS_PER_TASK = 1_000_000


def _by_day(df: DataFrame, table: str, rows: int = 0) -> DataFrame:
    """Rows under their day, dealt out for writing.

    Rows are range-partitioned on day, clustering columns and key: a day with very many rows is spread over several
    tasks, and each task writes to few days. Sorted files let a reader skip row groups on the clustering columns.
    Where a shuffle's usual tasks are too few for the number of rows, there are more.
    """
    order = [DAY, *schemas.CLUSTER_COLUMNS[table]]
    days = df.withColumn(DAY, F.to_date(schemas.DAY_COLUMN[table]))
    tasks = -(-rows // ROWS_PER_TASK)
    more = [tasks] if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else []
    return days.repartitionByRange(*more, *order, schemas.PRIMARY_KEY[table]).sortWithinPartitions(*order)


def _written(dealt: DataFrame, path: str, table: str, mode: str, max_records_per_file: int) -> None:
    """Files by day; a bloom filter on the key lets look-ups by key skip row groups that can't hold it.

    Filters are as large as the keys of a file need, 2 KB to 1 MB; else a day of few rows would take 1 MB too.
    """
    (
        dealt.write.partitionBy(DAY).mode(mode).option("maxRecordsPerFile", max_records_per_file)
        .option("compression", "zstd").option(f"parquet.bloom.filter.enabled#{schemas.PRIMARY_KEY[table]}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true").option("parquet.bloom.filter.candidates.number", "10")
        .parquet(path)
    )


def append(df: DataFrame, path: str, table: str, max_records_per_file: int = 5_000_000) -> None:
    _written(_by_day(df, table), path, table, "append", max_records_per_file)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stage(df: DataFrame, root: str, table: str) -> int:
    """Write rows as the next staged batch; gives its number."""
    spark = df.sparkSession
    number = manifest.next_number(manifest.entries(spark, root, table))
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/staging/{table}/batch={number}")
    manifest.commit(spark, root, table, number, "staged")
    return number


def _folders(spark: SparkSession, path: str, part: str, numbers: list[int]) -> DataFrame:
    """Only the named batches are listed and read."""
    return spark.read.option("basePath", path).parquet(*[f"{path}/{part}={n}" for n in numbers])


def pending(spark: SparkSession, root: str, table: str, batches: int | None = None) -> tuple[DataFrame | None, int]:
    """Rows of the staged batches above the high-water mark (the first `batches` of them), and the last one's number."""
    found = manifest.entries(spark, root, table)
    todo = manifest.numbers(found, "staged", manifest.mark(found, "load"))[:batches]
    if not todo:
        return None, 0
    return _folders(spark, f"{root}/staging/{table}", "batch", todo).drop("batch"), todo[-1]


def load_pending(
    spark: SparkSession, root: str, table: str, batches: int | None = None, max_records_per_file: int = 5_000_000
) -> int:
    """Load the staged batches that no load holds yet as one delta; gives the number of rows.

    Of several versions of a key in these batches the latest is loaded. The rows are counted while they are written. A
    load that died before its manifest entry is run again under the same number and overwrites what it left.
    """
    versions, upto = pending(spark, root, table, batches)
    if versions is None:
        return 0
    number = manifest.next_number(manifest.entries(spark, root, table))
    latest = dedup.latest_of_few(versions, schemas.PRIMARY_KEY[table])
    rows = _by_day(ingest.clean(latest, table), table, versions.count())
    counted = observed.Passing(rows)
    _written(counted.frame, f"{root}/warehouse/{table}/load={number}", table, "overwrite", max_records_per_file)
    manifest.commit(spark, root, table, number, "load", upto, counted.counts()["rows"])
    return counted.counts()["rows"]


def _live(spark: SparkSession, root: str, table: str) -> tuple[list[int], list[int]]:
    """The base (one number or none) and the deltas loaded since."""
    found = manifest.entries(spark, root, table)
    return manifest.numbers(found, "base")[-1:], manifest.numbers(found, "load", manifest.mark(found, "base"))


def read_versions(spark: SparkSession, root: str, table: str) -> DataFrame:
    """All row versions that are loaded and not compacted away, with the number of their load (`load`)."""
    base, deltas = _live(spark, root, table)
    return _folders(spark, f"{root}/warehouse/{table}", "load", base + deltas)


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The latest version of each key: the deltas' merged over the base.

    Only keys that the deltas hold are compared; all other rows come from the base as they are.
    """
    base, deltas = _live(spark, root, table)
    key, path = schemas.PRIMARY_KEY[table], f"{root}/warehouse/{table}"
    if not deltas:
        return _folders(spark, path, "load", base)
    new = _folders(spark, path, "load", deltas)
    if not base:
        return dedup.latest_rows(new, key)
    old, keys = _folders(spark, path, "load", base), new.select(key).distinct()
    merged = dedup.latest_rows(old.join(keys, key, "left_semi").unionByName(new), key)
    return old.join(keys, key, "left_anti").unionByName(merged)


def compact(spark: SparkSession, root: str, table: str, max_records_per_file: int = 5_000_000) -> int:
    """Write the current rows as a new base; gives their number. The folders merged into it are no longer read."""
    base, deltas = _live(spark, root, table)
    if not deltas:
        return 0
    number = manifest.next_number(manifest.entries(spark, root, table))
    counted = observed.Passing(_by_day(read_current(spark, root, table).drop("load", DAY), table))
    _written(counted.frame, f"{root}/warehouse/{table}/load={number}", table, "overwrite", max_records_per_file)
    manifest.commit(spark, root, table, number, "base", deltas[-1], counted.counts()["rows"])
    return counted.counts()["rows"]


def process_all_pending(
    spark: SparkSession, root: str, tables: tuple[str, ...] = ("products", "reviews", "pricing"),
    batches: int | None = None,
) -> dict[str, int]:
    return {table: load_pending(spark, root, table, batches) for table in tables}
