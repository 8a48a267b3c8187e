"""Append-only log writes and pass-through counting."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from keytide.sources.kafka import write_options


def append_log(
    stream: DataFrame, path: str, checkpoint: str, *, name: str | None = None, once: bool = True
) -> StreamingQuery:
    """Append a keyed stream to a Parquet log; each record lands once, also across restarts."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", path)
    if name:
        writer = writer.queryName(name)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def append_topic(stream: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Append binary ``key`` and ``value`` to a broker topic; a null value is a delete marker."""
    return (
        stream.select("key", "value")
        .writeStream.format("kafka")
        .options(**write_options(servers, topic))
        .option("checkpointLocation", checkpoint)
        .start()
    )


def counted(df: DataFrame, name: str) -> DataFrame:
    """The same rows; their number shows up in the query's progress under ``name``."""
    return df.observe(name, F.count(F.lit(1)).alias("records"))


def printed(stream: DataFrame, checkpoint: str, rows: int | None = None) -> StreamingQuery:
    """Show each micro-batch on the console: all its records, or the first ``rows``."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        shown = batch if rows is None else batch.limit(rows)
        for row in shown.toLocalIterator():  # partition by partition, as a console is one
            print(row)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(show).start()
