"""Broker topics. Needs Spark's Kafka connector, and its Avro module for Avro payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.avro.functions import from_avro
from pyspark.errors import AnalysisException

# Fixed value: bytes in front of each Avro payload (a marker byte and a 4-byte schema id).
WIRE_HEADER = 5


def read_options(
    servers: str, topic: str, *, latest: bool = False, records_per_batch: int | None = None
) -> dict[str, str]:
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest" if latest else "earliest",
    }
    if records_per_batch:
        options["maxOffsetsPerTrigger"] = str(records_per_batch)
    return options


def write_options(servers: str, topic: str) -> dict[str, str]:
    """Fully acknowledged, idempotent sends."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }


def stream_topic(spark: SparkSession, servers: str, topic: str, **bounds) -> DataFrame:
    """Binary ``key`` and ``value`` with ``off`` and ``ts``; decode with ``avro_value``.

    Offsets count per broker partition. A key stays in one partition, so ``off`` orders the
    records of a key; keep ``partition`` where a log-wide position is needed.
    """
    reader = spark.readStream.format("kafka").options(**read_options(servers, topic, **bounds))
    try:
        raw = reader.load()
    except AnalysisException as error:
        raise RuntimeError("reading a broker topic needs the spark-sql-kafka connector") from error
    return raw.select("key", "value", "partition", F.col("offset").alias("off"), F.col("timestamp").alias("ts"))


def avro_value(value: Column, schema_json: str) -> Column:
    """Decode an Avro payload behind its wire header."""
    payload = F.substring(value, WIRE_HEADER + 1, 2**31 - 1)
    return from_avro(payload, schema_json, {"mode": "FAILFAST"})


def avro_available(spark: SparkSession) -> bool:
    """Whether the session can decode Avro columns."""
    try:
        spark.range(0).select(from_avro(F.lit(b""), '"int"')).schema
    except Exception:
        return False
    return True
