"""Repeated-key operators on unbounded streams, as state per key.

For live streams: small batches, each touching few of the keys. A task meets one key's share of
one micro-batch, and ``count_repeats`` sorts it in memory, so bound the batch at the source
(``files_per_batch`` / ``bytes_per_batch``). For large batches and hot keys ``fold`` does the same
work with batch operators; where only the newest outcome per key matters,
``dedup.latest_repeat`` pre-aggregates it.

State grows with the number of keys; ``ttl_ms`` lets idle keys go (off by default). Such a query
keeps running empty batches to expire keys, so it must not be started with ``once``. Rows cross
to Python in Arrow batches that span keys, since most keys bring few rows per batch.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from operator import itemgetter
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keytide.functions.logs import ARRIVAL

# Processors travel to the executors by value, so that those need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keyed state needs the RocksDB store, which also keeps it out of the JVM heap."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)


class FlagRepeats(StatefulProcessor):
    """First record of a key unchanged, later ones with ``epoch`` one higher."""

    def __init__(self, columns: Sequence[str], order: Sequence[str], ttl_ms: int | None):
        self._row, self._epoch = Row(*columns), columns.index("epoch")
        self._position, self._ttl_ms = itemgetter(*[columns.index(name) for name in order]), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        schema = T.StructType([T.StructField("seen", T.BooleanType())])
        self._seen = handle.getValueState("seen", schema, self._ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        first = None
        if not self._seen.exists():
            # Only the earliest row so far is held back, whatever the number of rows.
            first = next(rows)
            self._seen.update((True,))
        for row in rows:
            if first is not None and self._position(row) < self._position(first):
                first, row = row, first
            values = list(row)
            values[self._epoch] += 1
            yield self._row(*values)
        if first is not None:
            yield first

    def close(self) -> None:
        pass


class CountRepeats(StatefulProcessor):
    """Every record replaced by the stored record of its key, ``epoch`` counting up."""

    def __init__(
        self, columns: Sequence[str], fields: T.StructType, order: Sequence[str], identity: str, ttl_ms: int | None
    ):
        self._row, self._schema, self._ttl_ms = Row(*columns), fields, ttl_ms
        self._places = [columns.index(name) for name in fields.fieldNames()]
        self._position = itemgetter(*[columns.index(name) for name in order])
        self._identity, self._epoch = columns.index(identity), columns.index("epoch")

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._stored = handle.getValueState("stored", self._schema, self._ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        stored = self._stored.get()
        current = None if stored is None else dict(zip(self._places, stored))
        for row in sorted(rows, key=self._position):
            identity = row[self._identity]  # a null identity equals none, as in the batch form
            if current is not None and identity is not None and current[self._identity] == identity:
                current[self._epoch] += 1
            else:
                current = {place: row[place] for place in self._places}
            yield self._row(*[current.get(place, value) for place, value in enumerate(row)])
        self._stored.update(tuple(current[place] for place in self._places))

    def close(self) -> None:
        pass


def _run(stream: DataFrame, key: str, processor: StatefulProcessor, ttl_ms: int | None) -> DataFrame:
    return stream.groupBy(key).transformWithState(
        statefulProcessor=processor,
        outputStructType=stream.schema,
        outputMode="Append",
        timeMode="ProcessingTime" if ttl_ms else "None",
    )


def flag_repeats(
    stream: DataFrame, key: str = "key", order: Sequence[str] = ARRIVAL, ttl_ms: int | None = None
) -> DataFrame:
    return _run(stream, key, FlagRepeats(stream.columns, order, ttl_ms), ttl_ms)


def count_repeats(
    stream: DataFrame,
    fields: T.StructType,
    key: str = "key",
    order: Sequence[str] = ARRIVAL,
    identity: str = "customerId",
    ttl_ms: int | None = None,
) -> DataFrame:
    return _run(stream, key, CountRepeats(stream.columns, fields, order, identity, ttl_ms), ttl_ms)
