"""Reports, checks and metrics as CSV or JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallwise.operators import metrics

# JSON keeps no more of a time than its format says.
MICROSECONDS = {c: "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" for c in ("timestampFormat", "timestampNTZFormat")}


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def metric_rows(samples: DataFrame) -> DataFrame:
    """Samples in export form; labels as JSON text, empty without labels."""
    labels = F.when(F.size("labels") > 0, F.to_json("labels")).otherwise("")
    return samples.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), F.col("name").alias("metric"),
        "value", "type", labels.alias("labels"),
    )


def write_metrics(samples: DataFrame, path: str, fmt: str = "csv") -> None:
    """Samples as CSV, or samples and current figures as JSON."""
    if fmt == "csv":
        write_csv(metric_rows(samples), path)
    elif fmt == "json":
        samples.select("ts", "name", "value", "type", "labels").write.mode("overwrite").options(**MICROSECONDS).json(f"{path}/samples")
        metrics.summary(samples).write.mode("overwrite").json(f"{path}/summary")
    else:
        raise ValueError(f"Unsupported format: {fmt}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Samples out of a JSON export."""
    schema = "ts timestamp_ntz, name string, value double, type string, labels map<string,string>"
    return spark.read.schema(schema).options(**MICROSECONDS).json(f"{path}/samples")


def write_report(report: DataFrame, path: str) -> None:
    """Report rows (section, metric, value) as JSON, one object per section."""
    entries = F.map_from_entries(F.collect_list(F.struct("metric", "value")))
    report.groupBy("section").agg(entries.alias("figures")).write.mode("overwrite").json(path)
