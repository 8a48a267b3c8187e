"""Streams processed in large batches by the batch operators, with a state table in between.

Each micro-batch runs through the same operator that works on whole logs, hot keys split and
all, together with what earlier batches left in the state: the stored record of every key of the batch,
put in front of its new rows, or the versions of the table and the records that wait for it. State lies in hash buckets
(``store``): a batch reads the buckets of its keys and adds a piece to each. What a batch appends and the manifest of its
state are one commit, so a batch that failed is replayed from the state it began with.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from keytide.operators import asof, dedup, tables
from keytide.settings import DEFAULT_LIMITS, Limits
from keytide.sinks import batches, commits
from keytide.streaming.store import AT, Store

LOG = "log"
_NEW = "_new"
_SIDE = "_side"

# (batch, its number, note of the last commit) -> (rows to append, what to do once they are written)
Step = Callable[[DataFrame, int, dict], tuple[DataFrame, Callable[[DataFrame], dict]]]


def start(stream: DataFrame, root: str, output: T.StructType, step: Step, once: bool = True) -> StreamingQuery:
    """Per batch: append the rows ``step`` gives to the log, let it renew the state from what was appended, then commit both.

    The state is what the note of the commit says, an empty one at first.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = commits.read(spark, root)
        if batch_id in before:
            return
        rows, renew = step(batch, batch_id, before.note)
        folder = batches.write_batch(rows.select(*output.fieldNames()), root, LOG, batch_id)
        note = renew(spark.read.schema(output).parquet(f"{root}/{LOG}/{folder}"))
        batches.commit(spark, root, batch_id, {LOG: folder}, note)

    writer = stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer).start()


def read_log(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return batches.read_committed(spark, root, LOG, schema).drop(batches.BATCH)


def count_repeats(
    stream: DataFrame,
    root: str,
    fields: T.StructType,
    key: str = "key",
    order: str = "off",
    identity: str = "customerId",
    limits: Limits = DEFAULT_LIMITS,
    once: bool = True,
    buckets: int | None = None,
) -> StreamingQuery:
    """Each record replaced by its key's stored record, ``epoch`` counting up."""
    names = fields.fieldNames()

    def number(rows: DataFrame) -> DataFrame:
        return dedup.count_repeats(rows, names, key, [_NEW, order], identity, limits)

    return _repeats(stream, root, number, key, names, order, once, buckets)


def flag_repeats(
    stream: DataFrame,
    root: str,
    key: str = "key",
    order: str = "off",
    limits: Limits = DEFAULT_LIMITS,
    once: bool = True,
    buckets: int | None = None,
) -> StreamingQuery:
    """First record of a key unchanged, later ones with ``epoch`` one higher."""

    def flag(rows: DataFrame) -> DataFrame:
        return dedup.flag_repeats(rows, key, [_NEW, order], limits)

    return _repeats(stream, root, flag, key, ["epoch"], order, once, buckets)


def _repeats(
    stream: DataFrame,
    root: str,
    operator: Callable[[DataFrame], DataFrame],
    key: str,
    stored: Sequence[str],
    order: str,
    once: bool,
    buckets: int | None,
) -> StreamingQuery:
    schema = T.StructType([stream.schema[name] for name in (key, *stored, order)])

    def newest(rows: DataFrame) -> DataFrame:
        return tables.latest_by_key(rows, [key], [*stored, order, AT], [AT])

    def step(batch: DataFrame, number: int, note: dict) -> tuple[DataFrame, Callable[[DataFrame], dict]]:
        store = Store(batch.sparkSession, f"{root}/state", schema, key, note.get("state"), buckets)
        store.clean()
        touched = store.touched(batch)
        before = newest(store.read(touched)).drop(AT)
        rows = before.withColumn(_NEW, F.lit(0)).unionByName(batch.withColumn(_NEW, F.lit(1)), allowMissingColumns=True)

        def renew(written: DataFrame) -> dict:
            last = tables.latest_by_key(written, [key], [*stored, order], [order])
            return {"state": store.add(last, number, touched, newest)}

        return operator(rows).where(F.col(_NEW) == 1), renew

    return start(stream, root, stream.schema, step, once)


def keep_first(
    stream: DataFrame, root: str, key: str = "key", order: str = "off", once: bool = True, buckets: int | None = None
) -> StreamingQuery:
    """The first record of each key, whole. A batch is reduced to one record per key before it moves."""
    schema = T.StructType([stream.schema[key]])

    def step(batch: DataFrame, number: int, note: dict) -> tuple[DataFrame, Callable[[DataFrame], dict]]:
        store = Store(batch.sparkSession, f"{root}/state", schema, key, note.get("state"), buckets)
        store.clean()
        touched = store.touched(batch)
        seen = store.read(touched).select(F.col(key).alias("_seen"))
        firsts = dedup.keep_first(batch, key, [order])

        def renew(written: DataFrame) -> dict:
            # Only keys that were new are added, so the pieces of a bucket share no key.
            return {"state": store.add(written.select(key), number, touched, lambda rows: rows)}

        return firsts.join(seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti"), renew

    return start(stream, root, stream.schema, step, once)


def keep_first_per_span(
    stream: DataFrame,
    root: str,
    span: str,
    late: str,
    key: str = "key",
    order: str = "off",
    event_time: str = "ts",
    once: bool = True,
    buckets: int | None = None,
) -> StreamingQuery:
    """The first record of each key in every span of event time; a key passes again in the next span.

    Spans have the length ``span`` and begin at 1970. The keys seen lie in a store per span, which is dropped as a whole once
    the newest record is ``late`` beyond the span's end. Records of a dropped span do not pass; neither do
    those without a time. So state holds the keys of the spans that the last ``late`` reaches into, however long
    the stream runs.
    """
    schema = T.StructType([stream.schema[key]])
    length, delay = _micros_of(stream.sparkSession, span), _micros_of(stream.sparkSession, late)

    def step(batch: DataFrame, number: int, note: dict) -> tuple[DataFrame, Callable[[DataFrame], dict]]:
        spark = batch.sparkSession
        for path in note.get("gone", []):
            commits.delete(spark, path)
        at = _micros(event_time)
        floor = note.get("floor")
        timed = batch.withColumn("_span", F.floor(at / length).cast("bigint")).where(F.col("_span").isNotNull())
        open_ = timed if floor is None else timed.where(F.col("_span") >= floor)
        told = open_.groupBy("_span").agg(F.max(at).alias("at")).collect()  # a row per span of the batch
        progress = max([r.at for r in told] + ([note["progress"]] if "progress" in note else []), default=None)
        held = note.get("spans", {})
        stores = {
            r["_span"]: Store(spark, f"{root}/state/{r['_span']}", schema, key, held.get(str(r["_span"])), buckets) for r in told
        }
        everything = list(range(max([store.buckets for store in stores.values()], default=0)))
        seen = [
            store.read(everything).select(F.col(key).alias("_seen"), F.lit(span_of).cast("bigint").alias("_seen_span"))
            for span_of, store in stores.items()
            if store.pieces
        ]
        firsts = tables.first_by_key(open_, [key, "_span"], [n for n in stream.columns if n != key], [order])
        for one in seen:  # an anti-join for each span that goes on from an earlier batch: few
            firsts = firsts.join(one, F.col(key).eqNullSafe(F.col("_seen")) & (F.col("_span") == F.col("_seen_span")), "left_anti")

        def renew(written: DataFrame) -> dict:
            spans = dict(held)
            rows = written.select(key, F.floor(_micros(event_time) / length).cast("bigint").alias("_span"))
            for span_of, store in stores.items():
                spans[str(span_of)] = store.add(rows.where(F.col("_span") == span_of), number, everything, lambda all_: all_)
            if progress is None:
                return note
            lowest = (progress - delay) // length
            if floor is not None:
                lowest = max(lowest, floor)
            gone = [f"{root}/state/{name}" for name in spans if int(name) < lowest]
            kept = {name: told_of for name, told_of in spans.items() if int(name) >= lowest}
            gone += [path for told_of in kept.values() for path in told_of["gone"]]
            return {"spans": kept, "gone": gone, "floor": lowest, "progress": progress}

        return firsts.select(*stream.columns), renew

    return start(stream, root, stream.schema, step, once)


def _micros(column: str) -> Column:
    return F.unix_micros(F.col(column).cast("timestamp"))


def _micros_of(spark: SparkSession, interval: str) -> int:
    begin = "timestamp '1970-01-01 00:00:00'"
    return spark.sql(f"SELECT unix_micros({begin} + interval {interval}) - unix_micros({begin})").first()[0]


@dataclass(frozen=True)
class ChangingJoin:
    """A running join; ``read`` gives what it has put out, and the rows it holds back as they stand."""

    query: StreamingQuery
    schema: T.StructType
    read: Callable[[], DataFrame]


def join_changing_table(
    stream: DataFrame,
    changes: DataFrame,
    root: str,
    stream_key: str,
    table_key: str,
    values: Sequence[str],
    how: str = "inner",
    limits: Limits = DEFAULT_LIMITS,
    once: bool = True,
    *,
    late_rows: str,
    late_changes: str = "0 seconds",
    buckets: int | None = None,
) -> ChangingJoin:
    """Join a stream to a table whose changes are a stream too.

    The rule: a record meets the table value of its own time, whatever the batches. So it is held back until the
    changes have gone beyond its time by ``late_changes`` (how far a change may arrive behind a newer one). Of every key the
    store keeps the version current ``late_rows`` before the newest record (how far a record may arrive behind) and all
    newer ones; older ones go when a bucket is written anew, so state does not grow with the time a stream runs. A record that
    is later than that may meet no version. Records without a key or time pass at once, unmatched. What is still held back
    at the end of the input, ``read`` joins as it stands.
    """
    spark = stream.sparkSession
    version = T.StructType([changes.schema[name] for name in (table_key, *values, "ts", "off")])
    output = T.StructType([*stream.schema.fields, *[changes.schema[name] for name in values]])
    both = stream.select(F.lit(0).alias(_SIDE), F.struct("*").alias("_row")).unionByName(
        changes.select(F.lit(1).alias(_SIDE), F.struct(*version.fieldNames()).alias("_change")),
        allowMissingColumns=True,
    )
    change_delay, row_delay = _micros_of(spark, late_changes), _micros_of(spark, late_rows)

    def store_of(note: dict) -> Store:
        return Store(spark, f"{root}/state", version, table_key, note.get("state"), buckets)

    def waiting_of(note: dict) -> DataFrame:
        if "waiting" not in note:
            return spark.createDataFrame([], stream.schema)
        return spark.read.schema(stream.schema).parquet(f"{root}/waiting/{note['waiting']}")

    def joined(rows: DataFrame, versions: DataFrame) -> DataFrame:
        return asof.join_as_of(rows, versions, stream_key, table_key, values, how, limits, merge=True)

    def current(progress: dict) -> Callable[[DataFrame], DataFrame]:
        """The versions that a record may still meet."""
        known = [progress[name] - delay for name, delay in (("rows", row_delay), ("changes", change_delay)) if progress[name] is not None]
        if len(known) < 2:
            return lambda rows: rows
        old = _micros("ts") <= min(known)

        def reduce(rows: DataFrame) -> DataFrame:
            last = tables.latest_by_key(rows.where(old), [table_key], [*values, "ts", "off", AT], ["ts", "off"])
            return rows.where(~old).unionByName(last.select(*rows.columns))

        return reduce

    def step(batch: DataFrame, number: int, note: dict) -> tuple[DataFrame, Callable[[DataFrame], dict]]:
        store, came = store_of(note), note.get("progress", {"rows": None, "changes": None})
        store.clean()
        if "passed" in note:
            commits.delete(spark, f"{root}/waiting/{note['passed']}")
        rows = waiting_of(note).unionByName(batch.where(F.col(_SIDE) == 0).select("_row.*"))
        fresh = batch.where(F.col(_SIDE) == 1).select("_change.*").where(F.col("ts").isNotNull() & F.col(table_key).isNotNull())
        at = F.coalesce(_micros("_row.ts"), _micros("_change.ts"))
        newest = batch.agg(
            F.max(F.when(F.col(_SIDE) == 0, at)).alias("rows"),
            F.max(F.when(F.col(_SIDE) == 1, at)).alias("changes"),
            F.collect_set(F.when(F.col(_SIDE) == 1, store.bucket(F.col(f"_change.{table_key}")))).alias("touched"),
        ).first()
        progress = {name: max((x for x in (came[name], newest[name]) if x is not None), default=None) for name in came}
        # Whether a change may still come that a row has to meet.
        held = F.col("ts").isNotNull() & F.col(stream_key).isNotNull()
        if progress["changes"] is not None:
            held = held & (_micros("ts") >= progress["changes"] - change_delay)
        versions = store.read([int(b) for b in store.pieces]).drop(AT).unionByName(fresh)

        def renew(_: DataFrame) -> dict:
            rows.where(held).write.mode("overwrite").parquet(f"{root}/waiting/{number}")
            told = {"waiting": number, "progress": progress}
            told["state"] = store.add(fresh, number, sorted(newest["touched"]), current(progress))
            return told | ({"passed": note["waiting"]} if "waiting" in note else {})

        return joined(rows.where(~F.coalesce(held, F.lit(False))), versions), renew

    def read() -> DataFrame:
        note = commits.read(spark, root).note
        store = store_of(note)
        rest = joined(waiting_of(note), store.read([int(b) for b in store.pieces]).drop(AT))
        return read_log(spark, root, output).unionByName(rest.select(*output.fieldNames()))

    return ChangingJoin(start(both, root, output, step, once), output, read)
