from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("keytide-tests")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return DATA


@pytest.fixture(scope="session")
def skewed(spark, tmp_path_factory) -> str:
    """The tables again, with a third of the events on one user and unordered ids."""
    from pyspark.sql import functions as F

    folder = str(tmp_path_factory.mktemp("skewed"))
    events = spark.read.parquet(f"{DATA}/events.parquet")
    hot = F.when(F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0, F.lit(5)).otherwise(F.col("user_id"))
    events.withColumn("user_id", hot.cast("bigint")).orderBy(F.xxhash64("event_id")).repartition(4).write.parquet(
        f"{folder}/events.parquet"
    )
    for name in ("part", "orders", "lineitem"):
        spark.read.parquet(f"{DATA}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder
