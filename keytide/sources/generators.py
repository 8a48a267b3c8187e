"""Synthetic logs as column expressions over a table of row numbers.

Every generator takes ``steps``: a column ``n`` (row number from 0) and ``ts``; ``numbered``
makes one from ``spark.range``. Values depend on (seed, n) only, so any partitioning, and any
retry, gives the same log. ``off`` is n.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from keytide.functions import binary, times, uniform
from keytide.functions.records import checked_enum
from keytide.functions.regions import REGIONS, region_field
from keytide.operators.fanout import MAX_FILES, revisions

# Default key space, ranges, and constants of the generated records.
LARGEST_ID = 1000
MIN_AGE, AGE_SPAN = 18, 50
FIRST_EPOCH = 1
ITEM_PRODUCTS, ITEM_ORDERS, ITEM_COUNT = 100, 100_000, 10
MAX_PRICE = 100
SENSOR_INT_BELOW = 100
SUIT_KEY, SUIT = 1, "DIAMONDS"
NUMBERS_MAX = 10_000


def numbered(spark: SparkSession, rows: int, start: str = "2024-01-01 00:00:00") -> DataFrame:
    """Row numbers with one record per second."""
    first = F.lit(start).cast("timestamp")
    return spark.range(rows).select(
        F.col("id").alias("n"), F.timestamp_seconds(F.unix_seconds(first) + F.col("id")).alias("ts")
    )


def _any_id(seed: int, field: str, largest: int) -> Column:
    return (uniform.below(seed, field, F.col("n"), largest) + 1).cast("bigint")


def _log(steps: DataFrame, key: Column, *fields: Column) -> DataFrame:
    return steps.select(key.alias("key"), *fields, F.col("n").alias("off"), "ts")


def customer_fields(customer_id: Column, ts: Column) -> list[Column]:
    """Every attribute of a customer follows from its id."""
    text = customer_id.cast("string")
    return [
        customer_id.alias("customerId"),
        F.concat(F.lit("first_"), text).alias("firstName"),
        F.concat(F.lit("last_"), text).alias("lastName"),
        F.concat(F.lit("email_"), text, F.lit("@email.com")).alias("email"),
        times.to_text(ts).alias("update"),
        (F.lit(MIN_AGE) + customer_id % AGE_SPAN).cast("int").alias("age"),
        region_field(customer_id, 0).alias("region"),
        F.lit(FIRST_EPOCH).alias("epoch"),
    ]


def customers(steps: DataFrame, seed: int, largest: int = LARGEST_ID) -> DataFrame:
    drawn = steps.withColumn("_id", _any_id(seed, "customer", largest))
    return _log(drawn, F.col("_id"), *customer_fields(F.col("_id"), F.col("ts")))


def customers_with_record_key(steps: DataFrame, seed: int, largest: int = LARGEST_ID) -> DataFrame:
    return customers(steps, seed, largest).withColumn("key", F.struct("customerId"))


def regions(steps: DataFrame, seed: int) -> DataFrame:
    drawn = steps.withColumn("_i", uniform.below(seed, "region", F.col("n"), len(REGIONS)))
    code, name, prefix = (region_field(F.col("_i"), field) for field in range(3))
    return _log(
        drawn,
        code,
        code.alias("identifier"),
        name.alias("longName"),
        prefix.alias("areaCode"),
        times.to_text(F.col("ts")).alias("update"),
    )


def products(steps: DataFrame, seed: int, largest: int = LARGEST_ID) -> DataFrame:
    drawn = steps.withColumn("_id", _any_id(seed, "product", largest))
    text = F.col("_id").cast("string")
    return _log(
        drawn,
        F.col("_id"),
        F.col("_id").alias("productId"),
        F.concat(F.lit("product_"), text).alias("name"),
        F.concat(F.lit("description_"), text).alias("description"),
    )


def orders(steps: DataFrame, seed: int, largest: int = LARGEST_ID) -> DataFrame:
    """The customer id is text here, as the record declares it; the date is in milliseconds."""
    drawn = steps.withColumn("_id", _any_id(seed, "order", largest))
    return _log(
        drawn,
        F.col("_id"),
        F.col("_id").alias("orderId"),
        times.epoch_millis(F.col("ts")).alias("date"),
        _any_id(seed, "order-customer", largest).cast("string").alias("customerId"),
        _any_id(seed, "order-amount", largest).cast("int").alias("orderAmount"),
    )


def order_items(steps: DataFrame, seed: int) -> DataFrame:
    n = F.col("n")
    drawn = steps.withColumn("_order", uniform.below(seed, "item-order", n, ITEM_ORDERS).cast("bigint"))
    cents = F.floor(uniform.unit(seed, "item-price", n) * MAX_PRICE * 100 + 0.5)
    return _log(
        drawn,
        F.col("_order"),
        uniform.below(seed, "item-product", n, ITEM_PRODUCTS).cast("bigint").alias("productId"),
        F.col("_order").alias("orderId"),
        (uniform.below(seed, "item-count", n, ITEM_COUNT) + 1).alias("count"),
        (cents.cast("double") / 100).alias("price"),
    )


def price_points(steps: DataFrame, seed: int, largest: int = LARGEST_ID) -> DataFrame:
    drawn = steps.withColumn("_id", _any_id(seed, "price-product", largest))
    return _log(
        drawn,
        F.col("_id"),
        F.col("_id").alias("productId"),
        (uniform.unit(seed, "price", F.col("n")) * MAX_PRICE).cast("float").alias("price"),
        times.epoch_millis(F.col("ts")).alias("date"),
    )


def sensors(steps: DataFrame, seed: int, largest: int = LARGEST_ID) -> DataFrame:
    """One of four kinds per reading: float in [0, 1), int below 100, boolean, boolean as text."""
    n = F.col("n")
    drawn = steps.withColumn("_id", _any_id(seed, "sensor", largest)).withColumn(
        "_kind", uniform.below(seed, "sensor-kind", n, 4)
    )
    kind = F.col("_kind")
    answer = uniform.below(seed, "sensor-flag", n, 2) == 1
    value = F.struct(
        F.when(kind == 1, uniform.below(seed, "sensor-int", n, SENSOR_INT_BELOW)).alias("member0"),
        F.when(kind == 0, uniform.unit(seed, "sensor-float", n).cast("float")).alias("member1"),
        F.when(kind == 2, answer).alias("member2"),
        F.when(kind == 3, F.when(answer, F.lit("true")).otherwise(F.lit("false"))).alias("member3"),
    )
    return _log(
        drawn,
        F.col("_id"),
        F.col("_id").alias("id"),
        times.to_text(F.col("ts")).alias("sensorTime"),
        value.alias("value"),
    )


def suits(steps: DataFrame) -> DataFrame:
    return _log(steps, F.lit(SUIT_KEY), checked_enum(F.lit(SUIT)).alias("suit"))


def binaries(steps: DataFrame) -> DataFrame:
    """The 128-bit counter: step n carries its start plus n + 1, keyed by the low 32 bits."""
    drawn = steps.withColumn("_id", binary.counter_bytes(F.col("n") + 1))
    return _log(
        drawn,
        binary.low_int32(F.col("_id")),
        F.col("_id").alias("id"),
        binary.integer_text(F.col("_id")).alias("payload"),
    )


def numbers(steps: DataFrame) -> DataFrame:
    """1, 2, 3, … without a key. ``NUMBERS_MAX - 1`` steps give the usual run."""
    return _log(steps, F.lit(None).cast("string"), (F.col("n") + 1).alias("value"))


def changes(
    steps: DataFrame, offset: int = 0, user: str = "developer", client: str = "developer_workspace"
) -> DataFrame:
    """Parent records; the date is in seconds."""
    number = F.col("n") + offset
    return _log(
        steps,
        number,
        number.alias("change"),
        times.epoch_seconds(F.col("ts")).alias("date"),
        F.lit(user).alias("user"),
        F.lit(client).alias("client"),
    )


def changes_with_revisions(
    steps: DataFrame, seed: int, offset: int = 0, max_files: int = MAX_FILES
) -> tuple[DataFrame, DataFrame]:
    parents = changes(steps, offset)
    return parents, revisions(parents, seed, max_files)
