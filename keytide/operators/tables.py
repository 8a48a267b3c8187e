"""Change logs as tables: newest value per key, deletes, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from keytide.functions.logs import ARRIVAL, position
from keytide.operators import ordered
from keytide.settings import DEFAULT_LIMITS, Limits

_VARIABLE_WIDTH = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType, T.VariantType)


def _pick(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str], pick, extra=()
) -> DataFrame:
    """One row per key, chosen by ``pick`` (max_by or min_by) over the order.

    Aggregates combine before the shuffle, so a hot key costs one row per task. With one
    order column and fixed-width values each column is its own aggregate, which keeps the
    plan a hash aggregate; otherwise the values travel as one struct.
    """
    at = position(order)
    wide = any(isinstance(df.schema[name].dataType, _VARIABLE_WIDTH) for name in values)
    if len(order) == 1 and not wide:
        picked = [pick(F.col(name), at).alias(f"_v_{name}") for name in values]
        return df.groupBy(*keys).agg(*picked, *extra).withColumnsRenamed({f"_v_{name}": name for name in values})
    grouped = df.groupBy(*keys).agg(pick(F.struct(*values), at).alias("_picked"), *extra)
    added = [name for name in grouped.columns if name not in keys and name != "_picked"]
    return grouped.select(*keys, *[F.col("_picked")[name].alias(name) for name in values], *added)


def latest_by_key(
    log: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str] = ARRIVAL
) -> DataFrame:
    """The table a change log stands for. Streams run it in update mode."""
    return _pick(log, keys, values, order, F.max_by)


def first_by_key(
    log: DataFrame, keys: Sequence[str], values: Sequence[str], order: Sequence[str] = ARRIVAL, extra=()
) -> DataFrame:
    return _pick(log, keys, values, order, F.min_by, extra)


def compact(
    log: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    deleted: Column,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """Newest value per key; a key whose newest record is a delete marker vanishes. A null marker is no delete."""
    return latest_with_deletes(log, keys, values, deleted, order).where(~F.col("is_deleted")).drop("is_deleted")


def latest_with_deletes(
    log: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    deleted: Column,
    order: Sequence[str] = ARRIVAL,
) -> DataFrame:
    """As ``compact``, but deleted keys stay and are marked: what an update stream must emit,
    since a filter cannot take back an earlier row."""
    return latest_by_key(log.withColumn("is_deleted", F.coalesce(deleted, F.lit(False))), keys, [*values, "is_deleted"], order)


def batch_counts(
    log: DataFrame, poll_size: int, limits: Limits = DEFAULT_LIMITS, *, dense: bool = False
) -> DataFrame:
    """Records per poll of ``poll_size``, and records read so far.

    Records are numbered in order of ``off``. ``dense`` says that offsets already are such numbers, from 0 without gaps,
    which saves the numbering.
    """
    log = log.select("off") if dense else ordered.positions(log.select("off"), "off", limits)
    counts = log.groupBy(F.expr(f"off div {poll_size}").alias("batch")).agg(F.count(F.lit(1)).alias("records"))
    return ordered.apply_in_order(counts, [], ["batch"], ordered.running_sum("records", "total"), limits)
