"""Raw landing files: `raw_data/<type>/<batch>` as JSON, CSV or text, with a listing by prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FORMATS = ("json", "csv", "text")


def raw_path(root: str, data_type: str, batch: str) -> str:
    return f"{root.rstrip('/')}/raw_data/{data_type}/{batch}"


def write_raw(df: DataFrame, root: str, data_type: str, batch: str, fmt: str = "json") -> str:
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    path = raw_path(root, data_type, batch)
    # A batch's path is written once; writing it again gives the same files, so a repeated job does no harm.
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    elif fmt == "json":
        writer = writer.option("ignoreNullFields", False)
    writer.format(fmt).save(path)
    return path


def read_raw(spark: SparkSession, schema: T.StructType, path: str, fmt: str = "json") -> DataFrame:
    if fmt not in FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    if fmt == "text":
        return spark.read.text(path)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.format(fmt).load(path)


def list_raw(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """Landing files (path, length) under a prefix. Only file status is read, never content."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*")
        .load(f"{root.rstrip('/')}/raw_data")
    )
    relative = F.regexp_extract("path", r"/raw_data/(.*)$", 1)
    return files.select(relative.alias("path"), "length").filter(F.col("path").startswith(prefix))
