"""Point-in-time lookups: the table value current when the stream record happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from keytide.operators import ordered
from keytide.operators.sizes import fits_broadcast
from keytide.settings import DEFAULT_LIMITS, Limits, written_table

_MICROS = "_micros"


def join_as_of(
    stream: DataFrame,
    changes: DataFrame,
    stream_key: str,
    table_key: str,
    values: Sequence[str],
    how: str = "inner",
    limits: Limits = DEFAULT_LIMITS,
    deleted: Column | None = None,
    merge: bool = False,
) -> DataFrame:
    """Each stream row with the newest ``values`` of its key at or before its ``ts``.

    A change at the same ``ts`` as a stream row comes first; of two changes of a key at one
    ``ts`` the later arrival counts. After a change for which ``deleted`` holds the key has no value until
    the next change. Unmatched rows drop (inner) or carry nulls (left). Nulls match nothing: neither changes nor stream
    rows without a key or a ``ts``.

    Versions become validity intervals, cut at the bounds of equal spans of time and broadcast; a stream
    row meets only those of its key and span, and does not move. Version tables beyond the broadcast bound, or with
    too many versions in one span, are merged with the stream in time order instead; so are all with ``merge``, which measures
    nothing first and suits the short inputs of micro-batches.
    """
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    known = changes.where(F.col(table_key).isNotNull() & F.col("ts").isNotNull())
    version = F.struct(*values, gone.alias("_gone"))
    at = [F.col(table_key).alias("_key"), F.col("ts").alias("_from")]
    if merge:
        versions = known.select(*at, F.col("off").cast("bigint").alias("_off"), version.alias("_version"))
        intervals = None
    else:
        newest = known.groupBy(*at).agg(F.max_by(version, F.col("off")).alias("_version"))
        versions = written_table(newest, "versions")
        intervals = _intervals(versions, limits)
        versions = versions.withColumn("_off", F.lit(0).cast("bigint"))
    if intervals is not None:
        joined = _by_interval(stream, *intervals, stream_key, how)
    else:
        joined = _by_merge(stream, versions, stream_key, how, limits)
    return joined.select(*stream.columns, *[F.col("_version")[name].alias(name) for name in values])


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _span_of(micros: Column, begin: int, width: int, spans: int) -> Column:
    """The span of time a moment lies in; the first and the last are open."""
    return F.greatest(F.lit(0), F.least(F.lit(spans - 1), F.floor((micros - begin) / F.lit(width)))).cast("long")


def _intervals(versions: DataFrame, limits: Limits) -> tuple[DataFrame, int, int, int] | None:
    """Versions as intervals by key and span, with begin and width of the spans and their number.

    None if they exceed the broadcast bound or ``versions_per_key`` of a key in one span.
    """
    if not fits_broadcast(versions, limits):
        return None
    at = _micros(F.col("_from"))
    per_key = versions.groupBy("_key").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("low"), F.max(at).alias("high"))
    keys, rows, most, low, high = per_key.agg(
        F.count(F.lit(1)), F.sum("n"), F.max("n"), F.min("low"), F.max("high")
    ).first()
    if not keys:
        return versions.select("_key", "_version", *[F.lit(0).cast("long").alias(n) for n in ("_begin", "_until", "_span")]), 0, 1, 1
    # As many spans as a key has versions, as far as every key's copy per span fits the bound.
    spans = max(1, min(most, (limits.broadcast_rows - rows) // keys))
    width = max(1, -(-(high - low + 1) // spans))
    until = F.lead(at).over(Window.partitionBy("_key").orderBy("_from"))
    begun = versions.select("_key", "_version", at.alias("_begin"), until.alias("_until"))
    first = _span_of(F.col("_begin"), low, width, spans)
    last = F.when(F.col("_until").isNull(), F.lit(spans - 1)).otherwise(_span_of(F.col("_until") - 1, low, width, spans))
    live = begun.where(~F.col("_version._gone"))
    cut = written_table(live.withColumn("_span", F.explode(F.sequence(first, last))), "intervals")
    busiest = cut.groupBy("_key", "_span").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0]
    if busiest > limits.versions_per_key or not fits_broadcast(cut, limits):
        return None
    return cut, low, width, spans


def _by_interval(
    stream: DataFrame, intervals: DataFrame, begin: int, width: int, spans: int, stream_key: str, how: str
) -> DataFrame:
    timed = stream.withColumn(_MICROS, _micros(F.col("ts")))
    current = (
        (F.col(stream_key) == F.col("_key"))
        & (_span_of(F.col(_MICROS), begin, width, spans) == F.col("_span"))
        & (F.col(_MICROS) >= F.col("_begin"))
        & (F.col("_until").isNull() | (F.col(_MICROS) < F.col("_until")))
    )
    return timed.join(F.broadcast(intervals), current, how)


def _by_merge(
    stream: DataFrame, versions: DataFrame, stream_key: str, how: str, limits: Limits
) -> DataFrame:
    # Rows without a time sort before all versions of their key, and so stay unmatched.
    rows = stream.select(
        F.col(stream_key).alias("_key"),
        F.col("ts").alias("_at"),
        F.lit(1).alias("_side"),
        F.col("off").cast("bigint").alias("_off"),
        F.struct(*stream.columns).alias("_row"),
    )
    marks = versions.select(
        "_key", F.col("_from").alias("_at"), F.lit(0).alias("_side"), "_off", "_version"
    )
    merged = rows.unionByName(marks, allowMissingColumns=True)
    carry_forward = ordered.last_value("_version", "_current")
    filled = ordered.apply_in_order(merged, ["_key"], ["_at", "_side", "_off"], carry_forward, limits)
    live = F.when(~F.col("_current._gone"), F.col("_current"))
    found = filled.where(F.col("_side") == 1).withColumn("_current", live)
    if how == "inner":
        found = found.where(F.col("_current").isNotNull())
    return found.select("_row.*", F.col("_current").alias("_version"))
