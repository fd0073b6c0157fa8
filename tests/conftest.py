from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join([str(ROOT), *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate a Column over literal inputs and give its value."""
    from pyspark.sql import functions as F

    def evaluate(build, *values, types=None):
        types = types or ["string"] * len(values)
        row = spark.range(1).select(*[F.lit(v).cast(t).alias(f"v{i}") for i, (v, t) in enumerate(zip(values, types))])
        return row.select(build(*[F.col(f"v{i}") for i in range(len(values))]).alias("x")).first()[0]

    return evaluate
