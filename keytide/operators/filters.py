"""Filters, projections and re-keying. None of them shuffles; predicates reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from keytide.functions import binary
from keytide.operators import ordered
from keytide.settings import DEFAULT_LIMITS, Limits

# The age bounds, all strict.
YOUNG_BELOW = 30
MIDDLE_ABOVE, MIDDLE_BELOW = 30, 55


def keep(df: DataFrame, predicate: Column) -> DataFrame:
    return df.where(predicate)


def younger(customers: DataFrame) -> DataFrame:
    return keep(customers, F.col("age") < YOUNG_BELOW)


def middle_aged(customers: DataFrame) -> DataFrame:
    return keep(customers, (F.col("age") > MIDDLE_ABOVE) & (F.col("age") < MIDDLE_BELOW))


def rekey(df: DataFrame, key: Column) -> DataFrame:
    """Replace the key. Stays a projection: a later join or aggregate shuffles if it must."""
    return df.withColumn("key", key)


def repartition_by_key(
    df: DataFrame, partitions: int | None = None, *, spread: int, by: str = "off"
) -> DataFrame:
    """Redistribute by key. With a ``spread`` of 1 all rows of a key are one task's.

    ``spread`` > 1 divides each key over that many hash buckets, chosen by the row's own
    position, so that a key with a third of all rows is not one task.
    """
    columns = [F.col("key")]
    if spread > 1:
        columns.append(F.pmod(F.xxhash64(by), F.lit(spread)))
    return df.repartition(partitions, *columns) if partitions else df.repartition(*columns)


def binary_to_hex(df: DataFrame) -> DataFrame:
    """Binary id records become records keyed and identified by upper-case hex text."""
    digits = binary.bytes_to_hex(F.col("id"))
    return df.withColumn("key", digits).withColumn("id", digits)


def from_position(df: DataFrame, start: int) -> DataFrame:
    """Start reading at an offset; nothing means from the beginning."""
    return df.where(F.col("off") >= start)


def until_count(
    df: DataFrame, max_messages: int, poll_size: int, *, dense: bool = False, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """What a reader sees that stops after the first full poll beyond ``max_messages``.

    ``max_messages`` <= 0 reads everything. Records are counted in order of ``off``; ``dense`` says that offsets count
    from 0 without gaps, so that they need not be numbered. Rows that share an offset go together.
    """
    if max_messages <= 0:
        return df
    most = (max_messages // poll_size + 1) * poll_size
    if dense:
        return df.where(F.col("off") < most)
    last = ordered.positions(df.select(F.col("off").alias("at"), "off"), "off", limits)
    bound = last.where(F.col("off") < most).agg(F.max("at")).first()[0]
    return df.where(F.col("off") <= bound) if bound is not None else df.limit(0)
