"""A replicated table that changes while streams look things up in it.

The table lies in versions under a root: ``publish`` writes one and commits it, and from then on it is the table. A stream looks
at the version mark before every micro-batch; only when that has moved does it read the table again and measure anew whether it can
be broadcast. Which version a batch met is kept in the batch's rows, and a batch that is replayed meets the version that it
met before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from keytide.operators import joins
from keytide.settings import DEFAULT_LIMITS, Limits
from keytide.sinks import batches, commits

VERSION = "table_version"
KEPT = 2  # versions before the newest that stay, for batches that have begun with them


def publish(table: DataFrame, root: str) -> int:
    """Make ``table`` the newest version; returns its number, counted from 0."""
    spark = table.sparkSession
    note = commits.read(spark, root).note
    number = note.get("version", -1) + 1
    table.write.mode("overwrite").parquet(f"{root}/versions/{number}")
    commits.add(spark, root, None, note={"version": number})
    if number > KEPT:
        commits.delete(spark, f"{root}/versions/{number - KEPT - 1}")
    return number


def newest(spark: SparkSession, root: str) -> int | None:
    """The version mark; None before the first version."""
    return commits.read(spark, root).note.get("version")


def start_lookup(
    stream: DataFrame,
    root: str,
    table_root: str,
    schema: T.StructType,
    stream_key: Column,
    table_key: str,
    how: str = "inner",
    shape: Callable[[DataFrame], DataFrame] = lambda joined: joined,
    limits: Limits = DEFAULT_LIMITS,
    once: bool = True,
) -> StreamingQuery:
    """Append each record of the stream, joined to the table as it stands when the record's batch begins, to the log ``root``.

    The table has one row per key and the columns of ``schema``; null keys match nothing, and before the first version it is
    empty (version -1). ``shape`` makes the rows to keep of the joined ones. See ``joins.lookup`` for tables too large to
    broadcast; a hot key of a batch is spread there. Read the result with ``read``.
    """
    held: dict = {"version": None}

    def table(spark: SparkSession, version: int) -> tuple[DataFrame, bool]:
        """The version, and whether it fits a broadcast; measured when the mark moves, not per batch."""
        if held["version"] != version:
            known = spark.read.schema(schema)
            rows = spark.createDataFrame([], schema) if version < 0 else known.parquet(f"{table_root}/versions/{version}")
            held.update(version=version, rows=rows, small=version < 0 or joins.fits_broadcast(rows, limits))
        return held["rows"], held["small"]

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if batches.is_committed(spark, root, number):
            return
        begun = commits.read(spark, f"{root}/begun").note
        if begun.get("batch") != number:
            found = newest(spark, table_root)
            begun = {"batch": number, "version": -1 if found is None else found}
            commits.add(spark, f"{root}/begun", None, note=begun)
        rows, small = table(spark, begun["version"])
        joined = joins.lookup(batch, rows, stream_key, table_key, how, limits, small=small)
        batches.write_atomically(root, number, {"log": shape(joined).withColumn(VERSION, F.lit(begun["version"]).cast("bigint"))})

    writer = stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """What a lookup has put out (``schema`` of the shaped rows), with the ``table_version`` that each batch met."""
    whole = T.StructType([*schema.fields, T.StructField(VERSION, T.LongType())])
    return batches.read_committed(spark, root, "log", whole).drop(batches.BATCH)
