"""Stream-to-table lookups: replicated where the table is measured small, shuffled beyond."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from keytide.operators.filters import rekey
from keytide.operators.ordered import flag_hot, hot_keys
from keytide.operators.sizes import fits_broadcast
from keytide.settings import DEFAULT_LIMITS, Limits

# What a customer joined to its region carries.
JOINED_FIELDS = ("customerId", "firstName", "lastName", "email", "age", "regionName", "areaCode")


def lookup(
    stream: DataFrame,
    table: DataFrame,
    stream_key: Column,
    table_key: str,
    how: str = "inner",
    limits: Limits = DEFAULT_LIMITS,
    small: bool | None = None,
) -> DataFrame:
    """Join each stream row to the table row of its key (the table has one row per key).

    A table within the bound is broadcast and the stream does not move. A larger one is
    joined by shuffle, with the stream rows of hot keys spread over pieces of ``salt_rows`` and
    only those keys' table rows repeated. Null keys match nothing. A table that is costly to
    compute should be passed written, since it is measured first. Keys of a stream cannot be
    counted: with a table beyond the bound, look up per micro-batch (``start_batches``). ``small`` says whether the table is
    within the bound where that has been measured already.
    """
    keyed = stream.withColumn("_key", stream_key)
    side = table.where(F.col(table_key).isNotNull())
    if fits_broadcast(side, limits) if small is None else small:
        return keyed.join(F.broadcast(side), F.col("_key") == F.col(table_key), how).drop("_key", table_key)
    return _shuffled(keyed, side, table_key, how, limits).drop("_key", table_key)


def _has_map(kind: T.DataType) -> bool:
    """Maps have no hash."""
    if isinstance(kind, T.StructType):
        return any(_has_map(field.dataType) for field in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType)) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def _shuffled(keyed: DataFrame, table: DataFrame, table_key: str, how: str, limits: Limits) -> DataFrame:
    same = F.col("_key") == F.col(table_key)
    hot = None if keyed.isStreaming else hot_keys(keyed.select("_key"), ["_key"], limits)
    if hot is None:
        return keyed.join(table.hint("merge"), same, how)
    # The salt comes from the whole row, so a retried task repeats it. Every hot key has as many
    # pieces as its rows need, so the repeated table rows stay few: rows / salt_rows + hot keys.
    row = F.xxhash64(*[F.col(f"`{name}`") for name in keyed.columns if not _has_map(keyed.schema[name].dataType)])
    pieces = F.ceil(F.col("_rows") / limits.salt_rows).cast("int")
    spread = flag_hot(keyed, ["_key"], hot, pieces.alias("_pieces"), limits).withColumn(
        "_salt", F.coalesce(F.pmod(row, F.col("_pieces")).cast("int"), F.lit(0))
    )
    table_hot = hot.withColumnRenamed("_key", table_key)
    repeated = flag_hot(table, [table_key], table_hot, pieces.alias("_pieces_t"), limits).withColumn(
        "_salt_t", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces_t"), F.lit(1)) - 1))
    )
    joined = spread.join(repeated.hint("merge"), same & (F.col("_salt") == F.col("_salt_t")), how)
    return joined.drop("_salt", "_salt_t", "_pieces", "_pieces_t")


def with_region(joined: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The joined record: seven fields, the region's long name as ``regionName``."""
    named = joined.withColumnRenamed("longName", "regionName")
    return named.select("key", *JOINED_FIELDS, "off", *extra)


def _region_lookup(customers: DataFrame, regions: DataFrame, how: str, limits: Limits) -> DataFrame:
    table = regions.select("identifier", "longName", "areaCode")
    return lookup(customers, table, F.col("region"), "identifier", how, limits)


def join_region_inner(customers: DataFrame, regions: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Re-key by region and join; customers of unknown regions drop; keyed by region."""
    return with_region(_region_lookup(rekey(customers, F.col("region")), regions, "inner", limits))


def join_region_left(customers: DataFrame, regions: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Every customer stays, with nulls where the region is unknown; keyed by customer id."""
    return with_region(rekey(_region_lookup(customers, regions, "left", limits), F.col("customerId")))


def join_region_replicated(
    customers: DataFrame, regions: DataFrame, limits: Limits = DEFAULT_LIMITS
) -> DataFrame:
    """Inner lookup in a replicated table; the customer keeps its key."""
    return with_region(_region_lookup(customers, regions, "inner", limits))
