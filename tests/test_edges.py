"""Hand-made edge cases of the expressions and batch operators."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from keytide.functions import binary, records, times, uniform
from keytide.functions.regions import REGIONS, region_table
from keytide.operators import asof, dedup, fanout, filters, joins, tables
from keytide.settings import Limits
from keytide.sources import generators, generic

T0 = datetime(2024, 1, 1)
FIELDS = ["customerId", "firstName", "epoch"]
SHUFFLED = Limits(broadcast_rows=0, hot_rows=1, segment_rows=2, salt_rows=1, versions_per_key=0)


def at(seconds: int) -> datetime:
    return datetime(2024, 1, 1, 0, 0, seconds)


def test_age_bounds_are_strict(spark):
    ages = spark.createDataFrame([(a,) for a in (18, 29, 30, 31, 54, 55, 67, None)], "age int")
    assert [r.age for r in filters.younger(ages).collect()] == [18, 29]
    assert [r.age for r in filters.middle_aged(ages).collect()] == [31, 54]


def test_hex_of_bytes(spark):
    values = [b"", b"\x00", b"\x0a", b"\xff", bytes(range(16))]
    df = spark.createDataFrame([(i, bytearray(v)) for i, v in enumerate(values)], "i int, id binary")
    got = [r.h for r in df.orderBy("i").select(binary.bytes_to_hex(F.col("id")).alias("h")).collect()]
    assert got == [v.hex().upper() for v in values]


def test_integer_text_and_signed_wrap(spark):
    values = [0, 1, 10, 255, 2**31 - 1, 2**31, 2**32 - 1, 2**64, binary.COUNTER_START]
    df = spark.createDataFrame([(i, bytearray(v.to_bytes(16, "big"))) for i, v in enumerate(values)], "i int, id binary")
    got = df.orderBy("i").select(binary.integer_text("id").alias("t"), binary.low_int32(F.col("id")).alias("w")).collect()
    assert [r.t for r in got] == [format(v, "x") for v in values]
    assert [r.w for r in got] == [((v + 2**31) % 2**32) - 2**31 for v in values]


def test_counter_carries_into_high_half(spark):
    start_low = binary.COUNTER_START % 2**64
    steps = [0, 1, 10_000, 2**64 - start_low - 1, 2**64 - start_low, 2**63 - 1]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(steps)], "i int, n bigint")
    got = [bytes(r.b) for r in df.orderBy("i").select(binary.counter_bytes(F.col("n")).alias("b")).collect()]
    assert got == [(binary.COUNTER_START + s).to_bytes(16, "big") for s in steps]


def test_timestamp_text_in_any_zone(spark):
    texts = ["2024/03/01 12:00:00 +02:00", "2024/03/01 12:00:00 -05:30", "2024/03/01 12:00:00 +00:00", "yesterday"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.s for r in df.orderBy("i").select(times.epoch_seconds(times.from_text(F.col("t"))).alias("s")).collect()]
    noon = int(datetime(2024, 3, 1, 12).timestamp() - datetime(1970, 1, 1).timestamp())
    assert got == [noon - 7200, noon + 19800, noon, None]


def test_enum_outside_the_set_is_rejected(spark):
    df = spark.createDataFrame([("HEARTS",), (None,)], "s string")
    assert [r.s for r in df.select(records.checked_enum(F.col("s")).alias("s")).collect()] == ["HEARTS", None]
    with pytest.raises(Exception, match="not an allowed value: STARS"):
        spark.createDataFrame([("STARS",)], "s string").select(records.checked_enum(F.col("s"))).collect()


def test_order_amount_default(spark):
    df = spark.createDataFrame([(None,), (7,)], "a int").select(records.order_amount(F.col("a")).alias("a"))
    assert sorted(r.a for r in df.collect()) == [1, 7]


def test_union_members_stay_distinct(spark):
    rows = [(0, (1, None, None, None)), (1, (None, 1.5, None, None)), (2, (None, None, True, None)), (3, (None, None, None, "true"))]
    schema = "i int, value struct<member0:int,member1:float,member2:boolean,member3:string>"
    value = F.col("value")
    df = spark.createDataFrame(rows, schema).select(
        "i",
        records.union_kind(value).alias("kind"),
        F.schema_of_variant(records.union_variant(value)).alias("type"),
        F.to_json(records.union_variant(value)).alias("text"),
    )
    got = [tuple(r)[1:] for r in df.orderBy("i").collect()]
    assert got == [
        ("int", "BIGINT", "1"),
        ("float", "FLOAT", "1.5"),
        ("boolean", "BOOLEAN", "true"),
        ("string", "STRING", '"true"'),
    ]


def test_region_codes_share_a_prefix(spark):
    table = region_table(spark)
    assert [tuple(r) for r in table.collect()] == list(REGIONS)
    shared = table.groupBy("areaCode").count().where("count > 1").collect()
    assert [(r.areaCode, r["count"]) for r in shared] == [("+49", 2)]


LOG = "key string, value int, deleted boolean, off bigint"


def test_compaction_with_deletes(spark):
    log = spark.createDataFrame(
        [("a", 1, False, 0), ("b", 1, False, 1), ("a", None, True, 2), ("b", None, True, 3), ("a", 2, False, 4), ("c", None, False, 5)],
        LOG,
    )
    got = tables.compact(log, ["key"], ["value"], F.col("deleted")).collect()
    assert sorted((r.key, r.value) for r in got) == [("a", 2), ("c", None)]
    marked = tables.latest_with_deletes(log, ["key"], ["value"], F.col("deleted")).collect()
    assert sorted((r.key, r.is_deleted) for r in marked) == [("a", False), ("b", True), ("c", False)]


@pytest.mark.parametrize("order", [("off",), ("ts", "off")])
def test_ties_go_to_the_later_arrival(spark, order):
    rows = [("a", "x", 1, T0, 0), ("a", "y", 2, T0, 1), ("b", "z", 3, T0, 2)]
    log = spark.createDataFrame(rows, "key string, name string, value int, ts timestamp, off bigint")
    wide = tables.latest_by_key(log, ["key"], ["name", "value"], order).collect()
    narrow = tables.latest_by_key(log, ["key"], ["value"], order).collect()
    assert sorted(map(tuple, wide)) == [("a", "y", 2), ("b", "z", 3)]
    assert sorted(map(tuple, narrow)) == [("a", 2), ("b", 3)]
    first = dedup.keep_first(log, order=order).collect()
    assert sorted((r.key, r.name) for r in first) == [("a", "x"), ("b", "z")]


def customers(spark, regions):
    rows = [(i, i, f"f{i}", f"l{i}", f"e{i}", 30, region, i) for i, region in enumerate(regions)]
    return spark.createDataFrame(
        rows, "key bigint, customerId bigint, firstName string, lastName string, email string, age int, region string, off bigint"
    )


@pytest.mark.parametrize("limits", [Limits(), SHUFFLED], ids=["replicated", "shuffled"])
def test_unknown_and_null_regions(spark, limits):
    people = customers(spark, [None, "XX", "DE", "DE", "DE", None, None])
    regions = region_table(spark)
    inner = joins.join_region_inner(people, regions, limits).collect()
    assert sorted((r.key, r.customerId, r.regionName) for r in inner) == [("DE", i, "Germany") for i in (2, 3, 4)]
    left = joins.join_region_left(people, regions, limits).collect()
    assert sorted((r.key, r.regionName or "") for r in left) == [
        (0, ""), (1, ""), (2, "Germany"), (3, "Germany"), (4, "Germany"), (5, ""), (6, "")
    ]
    replicated = joins.join_region_replicated(people, regions, limits).collect()
    assert sorted((r.key, r.areaCode) for r in replicated) == [(i, "+49") for i in (2, 3, 4)]


@pytest.mark.parametrize(
    "limits",
    [Limits(), Limits(versions_per_key=0), Limits(versions_per_key=0, hot_rows=1, segment_rows=2)],
    ids=["intervals", "merged", "segmented"],
)
def test_as_of_takes_the_version_current_then(spark, limits):
    stream = spark.createDataFrame(
        [("DE", at(1), 0), ("DE", at(5), 1), ("DE", at(9), 2), ("FR", at(9), 3), (None, at(9), 4)],
        "region string, ts timestamp, off bigint",
    )
    changes = spark.createDataFrame(
        [("DE", "v1", at(2), 10), ("DE", "v2", at(5), 11), ("DE", "v3", at(5), 12), ("DE", "v4", at(8), 13), (None, "v", at(1), 14)],
        "identifier string, version string, ts timestamp, off bigint",
    )
    left = asof.join_as_of(stream, changes, "region", "identifier", ["version"], "left", limits)
    assert sorted((r.off, r.version) for r in left.collect()) == [(0, None), (1, "v3"), (2, "v4"), (3, None), (4, None)]
    inner = asof.join_as_of(stream, changes, "region", "identifier", ["version"], "inner", limits)
    assert sorted((r.off, r.version) for r in inner.collect()) == [(1, "v3"), (2, "v4")]


REPEATS = "key bigint, customerId bigint, firstName string, epoch int, off bigint"


@pytest.mark.parametrize("limits", [Limits(), SHUFFLED], ids=["plain", "split"])
def test_repeats_with_changed_attributes(spark, limits):
    log = spark.createDataFrame([(1, 1, "a", 1, 0), (1, 1, "b", 1, 1), (1, 1, "c", 1, 2), (2, 2, "z", 1, 3)], REPEATS)
    flagged = dedup.flag_repeats(log, limits=limits).collect()
    assert sorted((r.off, r.firstName, r.epoch) for r in flagged) == [(0, "a", 1), (1, "b", 2), (2, "c", 2), (3, "z", 1)]
    counted = dedup.count_repeats(log, FIELDS, limits=limits).collect()
    assert sorted((r.off, r.firstName, r.epoch) for r in counted) == [(0, "a", 1), (1, "a", 2), (2, "a", 3), (3, "z", 1)]
    newest = dedup.latest_repeat(log, FIELDS).collect()
    assert sorted((r.key, r.firstName, r.epoch) for r in newest) == [(1, "a", 3), (2, "z", 1)]


@pytest.mark.parametrize("limits", [Limits(), SHUFFLED], ids=["plain", "split"])
def test_other_identity_passes_and_is_stored(spark, limits):
    log = spark.createDataFrame(
        [(1, 1, "a", 1, 0), (1, 9, "b", 4, 1), (1, 9, "c", 1, 2), (1, 1, "d", 1, 3), (1, 1, "e", 1, 4)], REPEATS
    )
    got = dedup.count_repeats(log, FIELDS, limits=limits).orderBy("off").collect()
    assert [(r.customerId, r.firstName, r.epoch) for r in got] == [
        (1, "a", 1), (9, "b", 4), (9, "b", 5), (1, "d", 1), (1, "d", 2)
    ]


@pytest.mark.parametrize(
    ("most", "gap", "deletes"), [(0, 5, 0), (5, 5, 0), (6, 5, 0), (7, 5, 1), (50, 5, 44), (3, 0, 2)]
)
def test_counter_delete_counts(spark, most, gap, deletes):
    steps = spark.range(most).select(F.col("id").alias("n"), F.col("id").alias("timestamp"))
    log = fanout.counter_log(steps, 100, gap)
    assert log.where("is_deleted").count() == deletes == max(0, most - gap - 1)
    live = tables.compact(log, ["key"], ["timestamp"], F.col("is_deleted")).collect()
    assert sorted(r.key for r in live) == list(range(100 + most - min(most, gap + 1) + 1, 100 + most + 1))


def test_counter_without_gap_deletes_nothing(spark):
    steps = spark.range(30).select(F.col("id").alias("n"), F.col("id").alias("timestamp"))
    log = fanout.counter_log(steps, 7, None)
    assert sorted(r.key for r in log.where("NOT is_deleted").collect()) == list(range(8, 38)) and log.count() == 30


def test_counter_log_in_order_matches_a_queue(spark):
    steps = spark.range(30).select(F.col("id").alias("n"), F.col("id").alias("timestamp"))
    got = [(r.key, r.is_deleted) for r in fanout.counter_log(steps, 7, 4).orderBy("off").collect()]
    live, want = [], []
    for i in range(30):
        live.append(7 + i + 1)
        want.append((live[-1], False))
        if i > 4:
            want.append((live.pop(0), True))
    assert got == want


def test_bounded_read_stops_after_the_poll_that_exceeds(spark):
    log = spark.range(10).select(F.col("id").alias("off"))
    assert filters.until_count(log, 4, 3).count() == 6
    assert filters.until_count(log, 3, 3).count() == 6
    assert filters.until_count(log, 2, 3).count() == 3
    assert filters.until_count(log, 0, 3).count() == filters.until_count(log, -1, 3).count() == 10


def test_repartition_spreads_a_hot_key(spark):
    log = spark.range(8000).select(F.lit("k").alias("key"), F.col("id").alias("off"))
    sizes = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes(filters.repartition_by_key(log, 8, spread=1))) == 8000
    spread = sizes(filters.repartition_by_key(log, 8, spread=64))
    assert sum(spread) == 8000 and max(spread) < 2500


def test_malformed_payload_is_an_error(spark):
    mixed = spark.createDataFrame([("schema.Product", "1", '{"productId": "x"')], "schema_name string, key string, payload string")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        generic.route(mixed, "schema.Product").collect()


def test_generated_values_ignore_partitioning(spark):
    steps = generators.numbered(spark, 2000)
    once = generators.sensors(steps.repartition(7), 3).orderBy("off").collect()
    again = generators.sensors(steps.coalesce(1), 3).orderBy("off").collect()
    assert once == again
    assert once != generators.sensors(steps, 4).orderBy("off").collect()


def test_generated_ranges(spark):
    steps = generators.numbered(spark, 20_000)
    person = generators.customers(steps, 1).agg(
        F.min("customerId"), F.max("customerId"), F.min("age"), F.max("age"), F.countDistinct("region")
    ).first()
    assert tuple(person) == (1, 1000, 18, 67, 14)
    item = generators.order_items(steps, 1).agg(
        F.min("productId"), F.max("productId"), F.min("count"), F.max("count"), F.min("price") >= 0, F.max("price") <= 100
    ).first()
    assert tuple(item) == (0, 99, 1, 10, True, True)
    reading = generators.sensors(steps, 1).groupBy(records.union_kind(F.col("value")).alias("kind")).count().collect()
    assert {r.kind for r in reading} == {"int", "float", "boolean", "string"}
    assert all(abs(r["count"] - 5000) < 300 for r in reading)
    children = generators.changes_with_revisions(steps, 1)[1].groupBy("change").count().agg(F.min("count"), F.max("count"))
    assert tuple(children.first()) == (1, 10)
    assert generators.numbers(generators.numbered(spark, generators.NUMBERS_MAX - 1)).agg(F.min("value"), F.max("value")).first()[:] == (1, 9999)


def test_uniform_buckets(spark):
    drawn = spark.range(50_000).groupBy(uniform.below(1, "x", F.col("id"), 14).alias("b")).count().collect()
    assert len(drawn) == 14 and all(abs(r["count"] - 50_000 / 14) < 400 for r in drawn)
