"""Structured Streaming jobs over the same operators as the batch jobs."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise import schemas
from stallwise.functions import quality, text
from stallwise.operators import dedup
from stallwise.plans.views import exact_sum
from stallwise.streaming import silence


def read_table(spark: SparkSession, folder: str, table: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream a table: a folder of part files, or one file of that name. The folder may hold other tables too."""
    path = f"{folder.rstrip('/')}/{table}.parquet"
    found = spark.read.parquet(path)
    reader = spark.readStream.schema(found.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if any(file.rstrip("/").endswith(f"/{table}.parquet") for file in found.inputFiles()[:1]):
        # A stream lists folders only: of this one, the single file by its whole name.
        return reader.option("pathGlobFilter", f"{table}.parquet").parquet(folder)
    return reader.parquet(path)


def run_to_end(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there, into parquet files, and read them back."""
    query = (
        df.writeStream.format("parquet").outputMode(mode).option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_of_batch(stream: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row along `order` of each value of `keys` within a micro-batch, whatever tasks and files rows come from.

    Done once before the shuffle, where a key that very many rows share becomes a row per Arrow batch, and once after
    it, where a task holds its share of the micro-batch's distinct keys.
    """
    sorting = [(c, "ascending") for c in (*keys, *order)]

    def changes(column: pa.ChunkedArray) -> pa.Array:
        """Whether each value but the first differs from the one before; NULL equals NULL."""
        values = column.combine_chunks()
        before, now = values.slice(0, len(values) - 1), values.slice(1)
        differ = pc.fill_null(pc.not_equal(before, now), True)
        return pc.and_not(differ, pc.and_(before.is_null(), now.is_null()))

    def firsts(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if rows.num_rows:
            rows = rows.take(pc.sort_indices(rows, sorting, null_placement="at_start"))
            opens = reduce(pc.or_, [changes(rows.column(c)) for c in keys])
            opens = pa.concat_arrays([pa.array([True]), opens])
            yield from rows.filter(opens).combine_chunks().to_batches()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from firsts(pa.Table.from_batches([batch]))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            yield from firsts(pa.Table.from_batches(held))

    return stream.mapInArrow(each, stream.schema).repartition(*keys).mapInArrow(whole, stream.schema)


def unseen(stream: DataFrame, entity: str, as_of: Column) -> DataFrame:
    """The first row of each signature over the whole stream, with the columns of `dedup.stored_signature`.

    Signatures live in keyed state: a micro-batch looks up its own and adds the new ones, so its cost doesn't grow with
    the batches before it, and none is ever forgotten. To be started within `silence.keyed_state`, which keeps state on
    disk.
    """
    signature = dedup.stored_signature(entity, as_of)
    signed = stream.withColumns({c: part for c, part in signature.items() if c not in stream.columns})
    return first_of_batch(signed, [*signature], dedup.ORDER[entity]).dropDuplicates([*signature])


def ingest_batch(fresh: DataFrame, batch_id: int, entity: str, as_of: Column, root: str) -> None:
    """One micro-batch of unseen rows: scored and marked `kept` or not, in a folder named after the batch.

    The folder is overwritten as a whole, and the rows depend on the batch's input alone, so a replay leaves the same.
    """
    rows = fresh.drop(*[c for c in dedup.stored_signature(entity, as_of) if c.startswith("_")])
    scored = quality.with_scores(rows, entity, as_of).withColumn("kept", F.col("overall_score") >= F.lit(schemas.GATE[entity]))
    scored.write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/scored/batch={batch_id}")


def ingest(
    stream: DataFrame, entity: str, as_of: Column, root: str, checkpoint: str, version: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Ingest a stream; gives (kept rows, latest version of each key along `version`; counters per batch)."""
    counts = ingest_counts(stream, entity, as_of, root, checkpoint)
    kept = stream.sparkSession.read.parquet(f"{root}/scored").filter("kept").drop("kept", "batch")
    return dedup.latest_of_few(kept, schemas.PRIMARY_KEY[entity], version), counts


def ingest_counts(stream: DataFrame, entity: str, as_of: Column, root: str, checkpoint: str) -> DataFrame:
    """Ingest a stream; gives the counters per batch.

    Counters (entity, batch, rows, processed, duplicates, failures) take the number of rows read from the stream's own
    metrics, so nothing is read again to be counted.
    """
    spark = stream.sparkSession
    counted = stream.observe("read", F.count(F.lit(1)).alias("rows"))
    with silence.keyed_state(spark, {"spark.sql.streaming.numRecentProgressUpdates": "1000000"}):
        query = (
            unseen(counted, entity, as_of).writeStream.foreachBatch(lambda df, i: ingest_batch(df, i, entity, as_of, root))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    progress = [(p.batchId, p.observedMetrics["read"]["rows"]) for p in query.recentProgress if "read" in p.observedMetrics]
    read = spark.createDataFrame(progress, "batch long, rows long")
    read.write.mode("append").parquet(f"{root}/read")
    scored = spark.read.parquet(f"{root}/scored")
    outcome = scored.groupBy("batch").agg(F.count_if("kept").alias("processed"), F.count("*").alias("unique"))
    # A replayed batch reads the same rows again.
    read = spark.read.schema("batch long, rows long").parquet(f"{root}/read").groupBy("batch").agg(F.max("rows").alias("rows"))
    filled = read.join(outcome, "batch", "left").fillna(0, ["processed", "unique"])
    return filled.select(
        F.lit(entity).alias("entity"), "batch", "rows", "processed", (F.col("rows") - F.col("unique")).alias("duplicates"),
        (F.col("unique") - F.col("processed")).alias("failures"),
    )


def first_within(stream: DataFrame, keys: list[str], ts: str, delay: str, order: list[str]) -> DataFrame:
    """First row of each key, forgotten `delay` after its time, so that state stays bounded.

    Of the rows of one micro-batch the first along `order` wins; a row of an earlier micro-batch wins over all of them.
    """
    return (
        first_of_batch(stream, keys, order).withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
        .dropDuplicatesWithinWatermark(keys)
    )


def window_rows(samples: DataFrame, width: str = "1 hour") -> DataFrame:
    """Counter sums, last gauge values and timer figures per window and metric; on a stream or a whole table."""
    def of(kind: str, c: str) -> Column:
        return F.when(F.col("type") == kind, F.col(c))

    return (
        samples.groupBy(F.window("ts", width).alias("w"), "name")
        .agg(
            F.count("*").alias("samples"),
            exact_sum(of("counter", "value")).alias("counter_sum"),
            F.max_by(of("gauge", "value"), F.struct("ts", "seq")).alias("gauge_last"),
            F.min(of("timer", "value")).alias("timer_min"), F.max(of("timer", "value")).alias("timer_max"),
        )
        .select(
            F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "name", "samples", "counter_sum",
            "gauge_last", "timer_min", "timer_max",
        )
    )


def metric_windows(stream: DataFrame, delay: str = "1 hour", width: str = "1 hour") -> DataFrame:
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return window_rows(timed, width)


def active_spells(stream: DataFrame, key: str, delay: str = "1 hour", hours: int = schemas.STALE_HOURS) -> DataFrame:
    """Spells of activity per key; a spell is emitted once the key has been silent for `hours`, which is the alert."""
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return (
        timed.groupBy(F.session_window("ts", f"{hours} hours").alias("w"), key)
        .agg(F.count("*").alias("rows"))
        .select(
            key, F.col("w.start").alias("first_seen"),
            (F.col("w.end") - F.make_dt_interval(hours=F.lit(hours))).alias("last_seen"), "rows",
        )
    )


def keyed_by_text(stream: DataFrame, content: str) -> DataFrame:
    """Add the key under which two texts count as copies."""
    return stream.withColumn("copy_key", F.md5(text.strip(F.lower(content))))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
