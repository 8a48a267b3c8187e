"""Logs derived from the given tables, column by column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from keytide.functions.regions import REGIONS, region_field
from keytide.operators import tables
from keytide.schemas import TABLES
from keytide.settings import new_folder, written_table
from keytide.sources import generators, topics

# Parts in which a table arrives as a stream, and rows per file of a part.
ARRIVALS = 3
FILE_ROWS = 5_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def arrive(part: DataFrame, root: str, number: int, position: str) -> None:
    """Write one part of a table under ``root``, its files in order of ``position``."""
    files = max(1, part.count() // FILE_ROWS)
    part.repartitionByRange(files, position).write.parquet(f"{root}/{number}")


def parts_of(whole: DataFrame, position: str) -> list[DataFrame]:
    """A table as ARRIVALS parts by position; together they hold every row."""
    low, high = whole.agg(F.min(position), F.max(position)).first()
    if low is None:
        return [whole]
    cuts = [low + (high - low + 1) * i // ARRIVALS for i in range(1, ARRIVALS)]
    at = F.col(position)
    below = [whole.where(F.coalesce(at < cuts[0], F.lit(True)))]
    between = [whole.where((at >= a) & (at < b)) for a, b in zip(cuts, cuts[1:])]
    return [*below, *between, whole.where(at >= cuts[-1])]


_staged: dict[tuple, str] = {}


def _state_of(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of a table's files."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files.listStatus(where)))


def arrivals(spark: SparkSession, folder: str, name: str, position: str) -> str:
    """The table again, as files that arrived one part after the other. Written once per session and state of the table."""
    known = (spark.sparkContext.applicationId, folder, name, _state_of(spark, f"{folder}/{name}.parquet"))
    if known not in _staged:
        root = new_folder(spark, f"arrivals-{name}", lasting=True)
        for number, part in enumerate(parts_of(table(spark, folder, name), position)):
            arrive(part, root, number, position)
        _staged[known] = root
    return _staged[known]


def stream_of(spark: SparkSession, root: str, name: str) -> DataFrame:
    """What arrives under ``root``, a part per micro-batch."""
    files = len(spark.read.schema(TABLES[name]).parquet(f"{root}/*").inputFiles())
    return topics.stream_log(spark, f"{root}/*", TABLES[name], files_per_batch=max(1, files // ARRIVALS))


def table_stream(spark: SparkSession, folder: str, name: str, position: str) -> DataFrame:
    return stream_of(spark, arrivals(spark, folder, name, position), name)


def as_customers(events: DataFrame) -> DataFrame:
    """One customer record per event."""
    customer_id = F.col("user_id")
    return events.select(
        customer_id.alias("key"),
        *generators.customer_fields(customer_id, F.col("ts")),
        F.col("event_id").alias("off"),
        "ts",
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return as_customers(table(spark, folder, "events"))


def as_price_points(events: DataFrame) -> DataFrame:
    """One price per event, keyed by user."""
    return events.select(
        F.col("user_id").alias("key"), F.col("value").alias("price"), "ts", F.col("event_id").alias("off")
    )


def as_region_log(events: DataFrame) -> DataFrame:
    """A change log of regions: error events state a region, signup events delete one."""
    index = F.col("event_id") % len(REGIONS)
    return events.where(F.col("event_type").isin("error", "signup")).select(
        region_field(index, 0).alias("identifier"),
        region_field(index, 1).alias("longName"),
        region_field(index, 2).alias("areaCode"),
        (F.col("event_type") == "signup").alias("is_deleted"),
        F.col("event_id").alias("off"),
        "ts",
    )


def regions(spark: SparkSession, folder: str) -> DataFrame:
    """The regions that their change log leaves, so that inner and left joins differ."""
    log = as_region_log(table(spark, folder, "events"))
    return written_table(tables.compact(log, ["identifier"], ["longName", "areaCode"], F.col("is_deleted")), "regions")


def as_region_changes(events: DataFrame) -> DataFrame:
    """Every error event re-states a region with a new area code."""
    index = F.col("event_id") % len(REGIONS)
    return events.where(F.col("event_type") == "error").select(
        region_field(index, 0).alias("identifier"),
        region_field(index, 1).alias("regionName"),
        F.concat(region_field(index, 2), F.lit("#"), F.col("event_id").cast("string")).alias("areaCode"),
        F.col("event_id").alias("off"),
        "ts",
    )


def region_changes(spark: SparkSession, folder: str) -> DataFrame:
    return as_region_changes(table(spark, folder, "events"))


def event_steps(spark: SparkSession, folder: str) -> DataFrame:
    """Row numbers and times for the generators, one per event."""
    return table(spark, folder, "events").select(F.col("event_id").alias("n"), "ts")


def part_steps(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("n"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ts")
    )


def as_order_steps(orders: DataFrame) -> DataFrame:
    return orders.select(F.col("o_orderkey").alias("n"), F.col("o_orderdate").alias("ts"))


def order_steps(spark: SparkSession, folder: str) -> DataFrame:
    return as_order_steps(table(spark, folder, "orders"))


def products(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("key"),
        F.col("p_partkey").alias("productId"),
        F.col("p_name").alias("name"),
        F.concat(F.lit("description_"), F.col("p_partkey").cast("string")).alias("description"),
        F.col("p_partkey").alias("off"),
    )


def binaries(spark: SparkSession, folder: str) -> DataFrame:
    """A 16-byte id per part, from its name."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("key"),
        F.unhex(F.md5(F.col("p_name"))).alias("id"),
        F.col("p_type").alias("payload"),
        F.col("p_partkey").alias("off"),
    )
