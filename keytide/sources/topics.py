"""Logs stored as Parquet directories, read whole or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from keytide.schemas import record


def log_schema(value: T.StructType, key: T.DataType | None) -> T.StructType:
    """key (null typed string where records have none), the value's fields, off, ts."""
    return T.StructType(
        [
            T.StructField("key", key or T.StringType(), True),
            *value.fields,
            *record(("off", T.LongType()), ("ts", T.TimestampType())).fields,
        ]
    )


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def end_of_log(log: DataFrame, position: str = "off") -> int:
    """The position the next record will have at the least."""
    last = log.agg(F.max(position)).first()[0]
    return 0 if last is None else last + 1


def stream_log(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    start: int | None = None,
    position: str = "off",
    files_per_batch: int | None = None,
    bytes_per_batch: int | None = None,
) -> DataFrame:
    """The same log as a stream, from its beginning or from the position ``start``.

    To see only what arrives from now on, start at ``end_of_log`` and keep that number for
    restarts, or records written in between would be skipped. One of the two batch bounds keeps
    a micro-batch, and with it the share of one key that a stateful operator meets at once, to
    a chosen size.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    log = reader.parquet(path)
    return log if start is None else log.where(F.col(position) >= start)
