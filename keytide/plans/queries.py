"""Registered queries: (spark, folder of the given tables) -> DataFrame.

Streaming queries read the given tables as streams to their end, through a checkpoint and
sink under the shared folder, and return what the sink then holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from keytide.functions import binary, records, times
from keytide.operators import asof, dedup, fanout, filters, joins, tables
from keytide.plans import inputs
from keytide.schemas import CHANGE, CUSTOMER, CUSTOMER_WITH_REGION, REVISION
from keytide.settings import DEFAULT_LIMITS, Limits, new_folder, use_utc, written_table
from keytide.sinks import batches, logs
from keytide.sources import generators, generic
from keytide.streaming import fold, replica, state

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SEED = 7
# Poll size, and the offset of the counter and change runs below.
POLL_SIZE = 1000
COUNTER_OFFSET = 7
CHANGE_OFFSET = 100

_FIELDS = CUSTOMER.fieldNames()


def _query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(use_utc(spark), folder)

    QUERIES[function.__name__] = run
    return run


def _early(spark: SparkSession, folder: str) -> Limits:
    """Replicate nothing and split large keys early: the plans for tables and keys beyond the
    default bounds, on tables of any size. Never coarser than the defaults."""
    events = inputs.table(spark, folder, "events").count()
    return Limits(
        broadcast_rows=0,
        hot_rows=min(DEFAULT_LIMITS.hot_rows, max(100, events // 200)),
        segment_rows=min(DEFAULT_LIMITS.segment_rows, max(500, events // 64)),
        salt_rows=min(DEFAULT_LIMITS.salt_rows, max(100, events // 100)),
        versions_per_key=0,
    )


# --- scans ---------------------------------------------------------------------------------


@_query
def scan_customers(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.customers(spark, folder)


@_query
def scan_products(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.products(spark, folder)


@_query
def scan_price_points(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.as_price_points(inputs.table(spark, folder, "events"))


@_query
def scan_struct_key(spark: SparkSession, folder: str) -> DataFrame:
    keyed = inputs.customers(spark, folder).withColumn("key", F.struct("customerId"))
    return keyed.select(F.col("key.customerId").alias("key_customerId"), "lastName", "region", "off")


@_query
def scan_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return generators.numbers(inputs.event_steps(spark, folder)).select("key", "value")


def _mixed(spark: SparkSession, folder: str) -> DataFrame:
    customers = generic.as_generic(inputs.customers(spark, folder), "schema.Customer")
    return customers.unionByName(generic.as_generic(inputs.products(spark, folder), "schema.Product"))


@_query
def scan_generic(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder)


@_query
def route_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return generic.route(_mixed(spark, folder), "schema.Product")


@_query
def route_customers(spark: SparkSession, folder: str) -> DataFrame:
    return generic.route(_mixed(spark, folder), "schema.Customer")


@_query
def decode_customer(spark: SparkSession, folder: str) -> DataFrame:
    encoded = generic.encode_value(inputs.customers(spark, folder), CUSTOMER)
    return generic.decode_value(encoded, CUSTOMER)


@_query
def sensor_union(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    return generators.sensors(inputs.event_steps(spark, folder), SEED).select(
        "key",
        "id",
        "sensorTime",
        records.union_kind(value).alias("kind"),
        value["member0"].cast("string").alias("int_value"),
        value["member1"].alias("float_value"),
        value["member2"].cast("string").alias("boolean_value"),
        value["member3"].alias("string_value"),
        "off",
    )


@_query
def scan_from_latest(spark: SparkSession, folder: str) -> DataFrame:
    """A reader that joins when half of the log is written sees the rest."""
    customers = inputs.customers(spark, folder)
    return filters.from_position(customers, customers.count() // 2)


@_query
def scan_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """A reader told to stop after half of the log."""
    customers = inputs.customers(spark, folder)
    return filters.until_count(customers, customers.count() // 2, POLL_SIZE, dense=True)


# --- filters and projections ---------------------------------------------------------------


@_query
def filter_age_lt_30(spark: SparkSession, folder: str) -> DataFrame:
    return filters.younger(inputs.customers(spark, folder)).select("key", "lastName", "age")


@_query
def filter_age_range(spark: SparkSession, folder: str) -> DataFrame:
    return filters.middle_aged(inputs.customers(spark, folder))


@_query
def rekey_by_region(spark: SparkSession, folder: str) -> DataFrame:
    return filters.rekey(inputs.customers(spark, folder), F.col("region"))


@_query
def repartition_by_region(spark: SparkSession, folder: str) -> DataFrame:
    """Re-keyed and redistributed; few keys, so each is spread over several tasks."""
    customers = rekey_by_region(spark, folder)
    spread = max(8, customers.count() // DEFAULT_LIMITS.salt_rows)
    return filters.repartition_by_key(customers, spread=spread)


@_query
def binary_to_hex(spark: SparkSession, folder: str) -> DataFrame:
    return filters.binary_to_hex(inputs.binaries(spark, folder))


@_query
def integer_hex(spark: SparkSession, folder: str) -> DataFrame:
    ids = F.col("id")
    return inputs.binaries(spark, folder).select(
        F.col("key").alias("key"), binary.integer_text(ids).alias("text"), binary.low_int32(ids).alias("low")
    )


@_query
def time_text(spark: SparkSession, folder: str) -> DataFrame:
    """Timestamps as text, read back, and as epoch numbers."""
    text = times.to_text(F.col("ts"))
    return inputs.table(spark, folder, "events").select(
        F.col("event_id").alias("off"),
        text.alias("update"),
        times.epoch_seconds(times.from_text(text)).alias("read_back"),
        times.epoch_millis(F.col("ts")).alias("millis"),
        times.epoch_millis(times.from_millis(times.epoch_millis(F.col("ts")))).alias("millis_back"),
        times.epoch_seconds(times.from_seconds(times.epoch_seconds(F.col("ts")))).alias("seconds_back"),
    )


# --- tables --------------------------------------------------------------------------------


def _price_table(spark: SparkSession, folder: str) -> DataFrame:
    return tables.latest_by_key(scan_price_points(spark, folder), ["key"], ["price", "ts", "off"])


@_query
def price_table(spark: SparkSession, folder: str) -> DataFrame:
    return _price_table(spark, folder)


@_query
def latest_customer(spark: SparkSession, folder: str) -> DataFrame:
    return tables.latest_by_key(inputs.customers(spark, folder), ["key"], [*_FIELDS, "off"])


@_query
def latest_region(spark: SparkSession, folder: str) -> DataFrame:
    """The region table its change log stands for, newest by event time."""
    changes = inputs.region_changes(spark, folder)
    return tables.latest_by_key(changes, ["identifier"], ["regionName", "areaCode"], ["ts", "off"])


def _price_lookup(spark: SparkSession, folder: str, limits: Limits) -> DataFrame:
    current = written_table(
        _price_table(spark, folder).select(F.col("key").alias("table_key"), F.col("price").alias("latest_price")),
        "price-table",
    )
    points = scan_price_points(spark, folder)
    return joins.lookup(points, current, F.col("key"), "table_key", "inner", limits)


@_query
def price_lookup_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    return _price_lookup(spark, folder, DEFAULT_LIMITS)


@_query
def price_lookup_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The same lookup as it runs when the table is too large to replicate."""
    return _price_lookup(spark, folder, _early(spark, folder))


@_query
def price_table_changes(spark: SparkSession, folder: str) -> DataFrame:
    """The table's update stream, folded to the last update of each key."""
    state.use_rocksdb(spark)
    points = inputs.as_price_points(inputs.table_stream(spark, folder, "events", "event_id"))
    updates = tables.latest_by_key(points, ["key"], ["price", "ts", "off"])
    root = new_folder(spark, "price-changes")
    batches.start_batches(updates, root, batches.fan_out("changes"), output_mode="update", staged=False).awaitTermination()
    written = batches.read_committed(spark, root, "changes", updates.schema)
    return tables.latest_by_key(written, ["key"], ["price", "ts", "off"], ["batch_id"])


@_query
def compact_with_deletes(spark: SparkSession, folder: str) -> DataFrame:
    points = inputs.table(spark, folder, "events").select(
        F.col("user_id").alias("key"), F.col("value").alias("price"), "ts", F.col("event_id").alias("off"), "event_type"
    )
    return tables.compact(points, ["key"], ["price", "ts", "off"], F.col("event_type") == "error")


def _counter_log(spark: SparkSession, folder: str) -> DataFrame:
    steps = inputs.event_steps(spark, folder).select("n", times.epoch_millis(F.col("ts")).alias("timestamp"))
    return fanout.counter_log(steps, COUNTER_OFFSET)


@_query
def counter_log(spark: SparkSession, folder: str) -> DataFrame:
    """Inserts and delete markers; the times as text, since deletes have none."""
    return _counter_log(spark, folder).withColumn("timestamp", F.col("timestamp").cast("string"))


@_query
def counter_log_payload(spark: SparkSession, folder: str) -> DataFrame:
    """The counter log as keys and payloads; a delete marker has no payload."""
    return fanout.as_payload(_counter_log(spark, folder))


@_query
def counter_survivors(spark: SparkSession, folder: str) -> DataFrame:
    return tables.compact(_counter_log(spark, folder), ["key"], ["timestamp"], F.col("is_deleted"))


@_query
def batch_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tables.batch_counts(inputs.customers(spark, folder), POLL_SIZE, dense=True)


# --- joins ---------------------------------------------------------------------------------


@_query
def join_region_broadcast(spark: SparkSession, folder: str) -> DataFrame:
    return joins.join_region_replicated(inputs.customers(spark, folder), inputs.regions(spark, folder))


@_query
def join_region_inner(spark: SparkSession, folder: str) -> DataFrame:
    return joins.join_region_inner(inputs.customers(spark, folder), inputs.regions(spark, folder))


@_query
def join_region_inner_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    """The repartitioned form, as it runs when the table is too large to replicate."""
    return joins.join_region_inner(inputs.customers(spark, folder), inputs.regions(spark, folder), _early(spark, folder))


@_query
def join_region_left(spark: SparkSession, folder: str) -> DataFrame:
    return joins.join_region_left(inputs.customers(spark, folder), inputs.regions(spark, folder))


@_query
def join_region_left_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    return joins.join_region_left(inputs.customers(spark, folder), inputs.regions(spark, folder), _early(spark, folder))


@_query
def join_region_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The replicated join on a stream, appended to a keyed log and read back."""
    customers = inputs.as_customers(inputs.table_stream(spark, folder, "events", "event_id"))
    joined = joins.join_region_replicated(customers, inputs.regions(spark, folder))
    root = new_folder(spark, "join-region")
    logs.append_log(joined, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{root}/log")


@_query
def join_region_live(spark: SparkSession, folder: str) -> DataFrame:
    """The replicated join while the table changes: each part of the stream meets the regions as its own part of the
    change log leaves them."""
    source, root, regions = (new_folder(spark, f"live-{name}") for name in ("source", "log", "regions"))
    events, fields = inputs.table(spark, folder, "events"), ["identifier", "longName", "areaCode"]
    known = None
    for number, part in enumerate(inputs.parts_of(events, "event_id")):
        inputs.arrive(part, source, number, "event_id")
        known = part if known is None else known.unionByName(part)
        table = tables.compact(inputs.as_region_log(known), ["identifier"], fields[1:], F.col("is_deleted"))
        replica.publish(table, regions)
        customers = inputs.as_customers(inputs.stream_of(spark, source, "events"))
        replica.start_lookup(
            customers, root, regions, table.schema, F.col("region"), "identifier", shape=joins.with_region
        ).awaitTermination()
    return replica.read(spark, root, T.StructType([T.StructField("key", T.LongType()), *CUSTOMER_WITH_REGION.fields, T.StructField("off", T.LongType())]))


def _as_of(spark: SparkSession, folder: str, how: str, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    joined = asof.join_as_of(
        inputs.customers(spark, folder),
        inputs.region_changes(spark, folder),
        "region",
        "identifier",
        ["regionName", "areaCode"],
        how,
        limits,
    )
    key = F.col("region") if how == "inner" else F.col("customerId")
    return joins.with_region(filters.rekey(joined, key), ["ts"])


@_query
def join_region_asof_inner(spark: SparkSession, folder: str) -> DataFrame:
    return _as_of(spark, folder, "inner")


@_query
def join_region_asof_left(spark: SparkSession, folder: str) -> DataFrame:
    return _as_of(spark, folder, "left")


@_query
def join_region_asof_segmented(spark: SparkSession, folder: str) -> DataFrame:
    """The left form as it runs when single regions hold too many rows for one task."""
    return _as_of(spark, folder, "left", _early(spark, folder))


@_query
def join_region_asof_deletes(spark: SparkSession, folder: str) -> DataFrame:
    """A log with deletes: customers of a region that is gone at their time drop."""
    joined = asof.join_as_of(
        inputs.customers(spark, folder),
        inputs.as_region_log(inputs.table(spark, folder, "events")),
        "region",
        "identifier",
        ["longName", "areaCode"],
        deleted=F.col("is_deleted"),
    )
    return joins.with_region(joined, ["ts"])


@_query
def stream_region_changing(spark: SparkSession, folder: str) -> DataFrame:
    """Customers and region changes as two streams; the table changes while it is joined."""
    root = inputs.arrivals(spark, folder, "events", "event_id")
    customers = inputs.as_customers(inputs.stream_of(spark, root, "events"))
    changes = inputs.as_region_changes(inputs.stream_of(spark, root, "events"))
    running = fold.join_changing_table(
        customers, changes, new_folder(spark, "region-changing"), "region", "identifier", ["regionName", "areaCode"], "left",
        late_rows="1 hour",
    )
    running.query.awaitTermination()
    return joins.with_region(running.read(), ["ts"])


# --- repeated keys -------------------------------------------------------------------------


@_query
def dedup_first(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.keep_first(inputs.customers(spark, folder))


@_query
def dedup_epoch_flag(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.flag_repeats(inputs.customers(spark, folder))


@_query
def dedup_epoch_flag_shuffled(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.flag_repeats(inputs.customers(spark, folder), limits=_early(spark, folder))


@_query
def dedup_epoch_join(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.count_repeats(inputs.customers(spark, folder), _FIELDS)


@_query
def dedup_epoch_join_segmented(spark: SparkSession, folder: str) -> DataFrame:
    """The same, re-keyed by region so that every key is large and is cut into segments."""
    by_region = inputs.customers(spark, folder).withColumn("key", F.col("region"))
    return dedup.count_repeats(by_region, _FIELDS, identity="region", limits=_early(spark, folder))


@_query
def dedup_epoch_latest(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.latest_repeat(inputs.customers(spark, folder), _FIELDS)


def _stream_customers(spark: SparkSession, folder: str) -> DataFrame:
    state.use_rocksdb(spark)
    return inputs.as_customers(inputs.table_stream(spark, folder, "events", "event_id"))


def _appended(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    root = new_folder(spark, name)
    logs.append_log(stream, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/log")


@_query
def stream_epoch_flag(spark: SparkSession, folder: str) -> DataFrame:
    return _appended(spark, state.flag_repeats(_stream_customers(spark, folder)), "epoch-flag")


@_query
def stream_epoch_join(spark: SparkSession, folder: str) -> DataFrame:
    customers = _stream_customers(spark, folder)
    return _appended(spark, state.count_repeats(customers, CUSTOMER), "epoch-join")


@_query
def fold_epoch_flag(spark: SparkSession, folder: str) -> DataFrame:
    """The stream in large batches, by batch operators and a state table."""
    customers, root = _stream_customers(spark, folder), new_folder(spark, "fold-flag")
    fold.flag_repeats(customers, root).awaitTermination()
    return fold.read_log(spark, root, customers.schema)


@_query
def fold_epoch_join(spark: SparkSession, folder: str) -> DataFrame:
    customers, root = _stream_customers(spark, folder), new_folder(spark, "fold-join")
    fold.count_repeats(customers, root, CUSTOMER).awaitTermination()
    return fold.read_log(spark, root, customers.schema)


@_query
def stream_epoch_latest(spark: SparkSession, folder: str) -> DataFrame:
    newest = dedup.latest_repeat(_stream_customers(spark, folder), _FIELDS)
    root = new_folder(spark, "epoch-latest")
    batches.start_batches(newest, root, batches.fan_out("newest"), output_mode="update", staged=False).awaitTermination()
    written = batches.read_committed(spark, root, "newest", newest.schema)
    return tables.latest_by_key(written, ["key"], _FIELDS, ["batch_id"])


@_query
def stream_dedup_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The first record of every key, as a stream that lets each key through once."""
    customers, root = _stream_customers(spark, folder), new_folder(spark, "dedup")
    fold.keep_first(customers, root).awaitTermination()
    return fold.read_log(spark, root, customers.schema)


@_query
def stream_dedup_weekly(spark: SparkSession, folder: str) -> DataFrame:
    """The first record of every key in each week; a key passes again in the next, and old weeks' keys are forgotten."""
    customers, root = _stream_customers(spark, folder), new_folder(spark, "dedup-weekly")
    fold.keep_first_per_span(customers, root, "7 days", late="1 day").awaitTermination()
    return fold.read_log(spark, root, customers.schema)


# --- sinks ---------------------------------------------------------------------------------


@_query
def fan_out_two(spark: SparkSession, folder: str) -> DataFrame:
    customers = inputs.as_customers(inputs.table_stream(spark, folder, "events", "event_id"))
    root = new_folder(spark, "fan-out")
    batches.start_batches(customers, root, batches.fan_out("topic1", "topic2")).awaitTermination()
    first, second = (
        batches.read_committed(spark, root, name, customers.schema)
        .drop("batch_id")
        .withColumn("topic", F.lit(name))
        for name in ("topic1", "topic2")
    )
    return first.unionByName(second)


@_query
def stream_restart(spark: SparkSession, folder: str) -> DataFrame:
    """A reader that stops and starts again as the log grows sees every record once."""
    source, root = new_folder(spark, "arrivals-restart"), new_folder(spark, "restart")
    for number, part in enumerate(inputs.parts_of(inputs.table(spark, folder, "events"), "event_id")):
        inputs.arrive(part, source, number, "event_id")
        customers = inputs.as_customers(inputs.stream_of(spark, source, "events"))
        logs.append_log(customers, f"{root}/log", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(customers.schema).parquet(f"{root}/log")


@_query
def replay_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Every batch is written, and written again after its commit; records land once."""
    root, whole = new_folder(spark, "replay"), inputs.customers(spark, folder)
    for number, part in enumerate(inputs.parts_of(whole, "off")):
        for _ in range(2):
            batches.write_atomically(root, number, {"customer": part})
    return batches.read_committed(spark, root, "customer", whole.schema).drop("batch_id")


@_query
def observed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Records per batch that passed through a stream, as its commits tell them."""
    customers = inputs.as_customers(inputs.table_stream(spark, folder, "events", "event_id"))
    root = new_folder(spark, "observed")
    batches.start_batches(customers, root, batches.fan_out("customer"), staged=False, counted=True).awaitTermination()
    return batches.read_counts(spark, root).groupBy("table").agg(F.sum("records").alias("records"))


@_query
def stream_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """A running reader told to stop after a sixth of the log, and started again to stop after half of it. It stops at
    the end of the batch in which it has more than that."""
    events = inputs.table_stream(spark, folder, "events", "event_id")
    root, total = new_folder(spark, "bounded"), inputs.table(spark, folder, "events").count()
    customers = inputs.as_customers(events)
    for most in (total // 6, total // 2):
        batches.end(batches.start_batches(customers, root, batches.fan_out("customer"), staged=False, stop_after=most))
    return batches.read_committed(spark, root, "customer", customers.schema).drop("batch_id")


@_query
def atomic_change_revision(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as changes with their revisions, written together and joined back."""
    steps = inputs.as_order_steps(inputs.table_stream(spark, folder, "orders", "o_orderkey"))
    parents = generators.changes(steps, CHANGE_OFFSET).select(*CHANGE.fieldNames())
    root = new_folder(spark, "changes")

    def split(batch: DataFrame) -> dict[str, DataFrame]:
        return {"change": batch, "revision": fanout.revisions(batch, SEED)}

    batches.start_batches(parents, root, split).awaitTermination()
    change = batches.read_committed(spark, root, "change", CHANGE).drop("batch_id")
    revision = batches.read_committed(spark, root, "revision", REVISION).drop("batch_id")
    return change.join(revision, "change")


# --- generators ----------------------------------------------------------------------------


@_query
def gen_customer(spark: SparkSession, folder: str) -> DataFrame:
    return generators.customers(inputs.event_steps(spark, folder), SEED)


@_query
def gen_customer_keyed(spark: SparkSession, folder: str) -> DataFrame:
    keyed = generators.customers_with_record_key(inputs.event_steps(spark, folder), SEED)
    return keyed.withColumn("key_customerId", F.col("key.customerId")).drop("key")


@_query
def gen_region(spark: SparkSession, folder: str) -> DataFrame:
    return generators.regions(inputs.event_steps(spark, folder), SEED)


@_query
def gen_product(spark: SparkSession, folder: str) -> DataFrame:
    return generators.products(inputs.part_steps(spark, folder), SEED)


@_query
def gen_order(spark: SparkSession, folder: str) -> DataFrame:
    return generators.orders(inputs.order_steps(spark, folder), SEED)


@_query
def gen_order_item(spark: SparkSession, folder: str) -> DataFrame:
    return generators.order_items(inputs.event_steps(spark, folder), SEED)


@_query
def gen_price_point(spark: SparkSession, folder: str) -> DataFrame:
    return generators.price_points(inputs.event_steps(spark, folder), SEED)


@_query
def gen_suit(spark: SparkSession, folder: str) -> DataFrame:
    return generators.suits(inputs.event_steps(spark, folder))


@_query
def gen_binary(spark: SparkSession, folder: str) -> DataFrame:
    made = generators.binaries(inputs.event_steps(spark, folder))
    return made.withColumn("id", binary.bytes_to_hex(F.col("id")))


@_query
def gen_change_revision(spark: SparkSession, folder: str) -> DataFrame:
    _, children = generators.changes_with_revisions(inputs.order_steps(spark, folder), SEED, CHANGE_OFFSET)
    return children
