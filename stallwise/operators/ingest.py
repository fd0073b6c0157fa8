"""From gathered rows to kept rows: duplicates out, score, gate, counters; constraint quarantine; warehouse cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.functions import quality
from stallwise.operators import dedup
from stallwise.sources import observed

JSON_ARRAYS = {"products": ["images"], "reviews": [], "pricing": ["offers"]}
JSON_MAPS = {"products": ["specifications"], "reviews": [], "pricing": []}
TIME_COLUMNS = ["scraped_at", "last_updated", "review_date", "price_date"]


def gate(scored: DataFrame, entity: str) -> DataFrame:
    return scored.filter(F.col("overall_score") >= F.lit(schemas.GATE[entity]))


def score_unique(df: DataFrame, entity: str, as_of: Column) -> DataFrame:
    """First copies with their scores. Duplicates go before any scoring, so they are not paid for twice."""
    return quality.with_scores(dedup.drop_duplicates(df, entity, as_of), entity, as_of)


def ingest(df: DataFrame, entity: str, as_of: Column) -> DataFrame:
    """Rows that survive duplicates removal and the score gate."""
    return gate(score_unique(df, entity, as_of), entity)


COUNTERS = "status string, n long"


def _counters(spark: SparkSession, read: int, unique: int, processed: int) -> DataFrame:
    rows = [("processed", processed), ("duplicate", read - unique), ("failed", unique - processed)]
    return spark.createDataFrame(rows, COUNTERS)


def ingest_counts(df: DataFrame, entity: str, as_of: Column) -> DataFrame:
    """Counters (processed, duplicate, failed) of one ingest as rows (status, n).

    One job: the rows read are counted as they pass by on the way to the duplicates' removal.
    """
    kept = F.col("overall_score") >= F.lit(schemas.GATE[entity])
    read = observed.Passing(df)
    found = score_unique(read.frame, entity, as_of).agg(F.count("*").alias("unique"), F.count_if(kept).alias("processed")).first()
    return _counters(df.sparkSession, read.counts()["rows"], found.unique, found.processed)


def ingest_into(df: DataFrame, entity: str, as_of: Column, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ingest once and write what comes of it: (kept rows, rejected rows with scores and issues, counters).

    The input is read once; kept and rejected rows are partitions of one table, and all counters are taken while it is
    written.
    """
    spark = df.sparkSession
    read = observed.Passing(df)
    kept = F.coalesce(F.col("overall_score") >= F.lit(schemas.GATE[entity]), F.lit(False))
    rows = score_unique(read.frame, entity, as_of)
    rows = rows.withColumn("status", F.when(kept, "processed").otherwise("failed"))
    scored = observed.Passing(rows, processed=F.col("status") == "processed")
    scored.frame.write.mode("overwrite").partitionBy("status").parquet(folder)
    written = spark.read.schema(rows.schema).parquet(folder)
    parts = [written.filter(F.col("status") == status).drop("status") for status in ("processed", "failed")]
    return *parts, _counters(spark, read.counts()["rows"], *scored.counts().values())


def processing_stats(batches: DataFrame, since: Column | None = None) -> DataFrame:
    """Totals over the counters of many batches: columns (entity, batch_id, status, n, processed_at).

    With `since`, the time of a reset, earlier batches do not count.
    """
    if since is not None:
        batches = batches.filter(F.col("processed_at") >= since)

    def total(status: str) -> Column:
        return F.sum(F.when(F.col("status") == status, F.col("n")).otherwise(0))

    return batches.groupBy("entity").agg(
        total("processed").alias("processed"), total("duplicate").alias("duplicates_filtered"),
        total("failed").alias("validation_failures"), F.max("processed_at").alias("last_processed"),
    )


def with_violations(df: DataFrame, entity: str) -> DataFrame:
    return df.withColumn("violations", quality.violations(entity))


def split_valid(df: DataFrame, entity: str) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with their violations)."""
    checked = with_violations(df, entity)
    broken = F.size("violations") > 0
    return checked.filter(~broken).drop("violations"), checked.filter(broken)


def parse_json_columns(df: DataFrame, entity: str) -> DataFrame:
    """JSON text to arrays and maps; NULL stays NULL, bad text becomes the empty value of the column's type."""
    texts = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    parsed = {
        c: F.when(F.col(c).isNotNull(), F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>")))
        for c in JSON_ARRAYS[entity] if c in texts
    } | {
        c: F.when(
            F.col(c).isNotNull(),
            F.coalesce(F.from_json(c, "map<string,string>"), F.create_map().cast("map<string,string>")),
        )
        for c in JSON_MAPS[entity] if c in texts
    }
    return df.withColumns(parsed) if parsed else df


def clean(df: DataFrame, entity: str) -> DataFrame:
    """Staging rows in warehouse form: typed JSON and time columns, no processed flag."""
    texts = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    times = {c: F.try_to_timestamp(c).cast("timestamp_ntz") for c in TIME_COLUMNS if c in texts}
    typed = parse_json_columns(df, entity)
    return (typed.withColumns(times) if times else typed).drop("processed")
