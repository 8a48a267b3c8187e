"""Repeated keys: keep the first, flag the repeats, or count them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from keytide.functions.logs import ARRIVAL
from keytide.operators import ordered
from keytide.operators.sizes import fits_broadcast
from keytide.operators.tables import first_by_key
from keytide.settings import DEFAULT_LIMITS, Limits, written_table


def keep_first(log: DataFrame, key: str = "key", order: Sequence[str] = ARRIVAL) -> DataFrame:
    """The first record of each key; an aggregate, so repeats vanish before the shuffle."""
    return first_by_key(log, [key], [name for name in log.columns if name != key], order).select(*log.columns)


def flag_repeats(
    log: DataFrame, key: str = "key", order: Sequence[str] = ARRIVAL, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Every record as it came, with ``epoch`` one higher if its key was seen before.

    A row is the first of its key if it stands at the key's first position; of several rows of a key at
    that position, all are. A null key is a key. A row whose only order column is null comes after all others of
    its key; of several order columns a null sorts first. Few keys: the table of first positions
    is broadcast and the log does not move. Many: the join is by key and position, which spreads a hot key
    evenly.
    """
    found = first_by_key(log, [key], list(order), order)
    firsts = written_table(found.withColumnsRenamed({name: f"_first_{name}" for name in [key, *order]}), "first-positions")
    same = [F.col(name).eqNullSafe(F.col(f"_first_{name}")) for name in [key, *order]]
    marks = firsts.withColumn("_is_first", F.lit(True))
    side = F.broadcast(marks) if fits_broadcast(firsts, limits) else marks.hint("merge")
    repeat = F.when(F.col("_is_first"), F.lit(0)).otherwise(F.lit(1))
    marked = log.join(side, same, "left").withColumn("epoch", F.col("epoch") + repeat)
    return marked.select(*log.columns)


def count_repeats(
    log: DataFrame,
    fields: Sequence[str],
    key: str = "key",
    order: Sequence[str] = ARRIVAL,
    identity: str = "customerId",
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Every record replaced by the stored record of its key, ``epoch`` counting up.

    The stored record of a key is what was last emitted for it. A record whose ``identity``
    differs from the stored one passes unchanged and becomes the stored one, so a key's records
    form runs of equal identity: within a run the first record's fields repeat and the epoch
    grows by one per record. Normally identity and key agree and each key is a single run.

    ``fields`` are the record's columns; key and order columns stay those of the incoming row.
    """

    others = [name for name in log.columns if name not in fields]
    done = ordered.apply_in_order(log, [key], order, _runs(fields, identity), limits)
    since = (F.col("_n") - F.col("_stored._n")).cast("int")
    kept = [
        (F.col("_stored.epoch") + since).alias("epoch") if name == "epoch" else F.col(f"_stored.{name}").alias(name)
        for name in fields
    ]
    return done.select(*others, *kept).select(*log.columns)


def _runs(fields: Sequence[str], identity: str) -> ordered.Step:
    """Number the rows (``_n``) and give each the first record of its run (``_stored``)."""

    def local(rows: DataFrame, scope: ordered.Scope) -> DataFrame:
        same = F.lag(identity).over(scope.ordered) == F.col(identity)  # a null identity equals none
        marked = rows.withColumn("_n", F.row_number().over(scope.ordered).cast("bigint")).withColumn(
            "_start", F.when(~F.coalesce(same, F.lit(False)), F.struct("_n", *fields))
        )
        done = marked.withColumn("_stored", F.last("_start", ignorenulls=True).over(scope.so_far)).drop("_start")
        return done.withColumn("_opening", F.first(identity).over(scope.so_far)) if scope.segmented else done

    def finish(rows: DataFrame, ends: DataFrame, scope: ordered.Scope) -> DataFrame:
        # The first run of a segment may go on from the segment before. Then its true start is
        # the newest run start among the earlier segments.
        def shifted(by: Column) -> Column:
            return F.struct((F.col("_stored._n") + by).alias("_n"), *[F.col(f"_stored.{name}") for name in fields])

        first_run = F.col("_stored._n") == 1
        linked = ends.select(
            *scope.group,
            "_stored",
            F.coalesce(F.sum("_n").over(scope.earlier_segments), F.lit(0)).alias("_base"),
            F.coalesce(F.lag(identity).over(scope.by_segment) == F.col("_opening"), F.lit(False)).alias("_goes_on"),
        )
        begun = F.when(~(F.col("_goes_on") & first_run), shifted(F.col("_base")))
        inherited = F.last(begun, ignorenulls=True).over(scope.earlier_segments)
        carry = linked.select(
            *scope.group, "_base", F.when(F.col("_goes_on"), inherited).alias("_inherited")
        ).where(F.col("_base") > 0)
        attached = scope.attach(rows, carry).withColumn("_base", F.coalesce(F.col("_base"), F.lit(0)))
        stored = F.when(first_run & F.col("_inherited").isNotNull(), F.col("_inherited"))
        return (
            attached.withColumn("_stored", stored.otherwise(shifted(F.col("_base"))))
            .withColumn("_n", F.col("_n") + F.col("_base"))
            .drop("_base", "_inherited", "_opening")
        )

    return ordered.Step(local, finish)


def latest_repeat(log: DataFrame, fields: Sequence[str], key: str = "key", order: Sequence[str] = ARRIVAL) -> DataFrame:
    """Only the newest outcome of ``count_repeats`` per key, as one aggregate.

    For logs whose key is the record's identity. Runs on streams in update mode; partial
    aggregation makes it insensitive to hot keys.
    """
    counted = first_by_key(log, [key], list(fields), order, extra=[F.count(F.lit(1)).alias("_n")])
    return counted.withColumn("epoch", (F.col("epoch") + F.col("_n") - 1).cast("int")).drop("_n")


def keep_first_within(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Streaming form with bounded state: repeats within ``delay`` of event time drop."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def keep_first_unbounded(stream: DataFrame, key: str) -> DataFrame:
    """Streaming form that remembers every key."""
    return stream.dropDuplicates([key])
