"""The physical plans are the ones meant: what is read, what moves, what is broadcast."""

from __future__ import annotations

import re

import pytest

from keytide.operators import joins, tables
from keytide.plans import inputs
from keytide.plans.queries import QUERIES
from keytide.settings import Limits, new_folder, shared_folder


def plan(df) -> str:
    """The plan that ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def reads(text: str) -> list[set[str]]:
    return [set(re.findall(r"(\w+):", fields)) for fields in re.findall(r"ReadSchema: struct<(.*)>", text)]


@pytest.mark.parametrize(
    "name",
    [
        "scan_customers",
        "scan_generic",
        "filter_age_range",
        "rekey_by_region",
        "binary_to_hex",
        "join_region_broadcast",
        "join_region_inner",
        "join_region_left",
        "price_lookup_broadcast",
        "dedup_epoch_flag",
        "counter_log",
        "gen_customer",
    ],
)
def test_the_log_does_not_move(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "hashpartitioning" not in text and "rangepartitioning" not in text and "SinglePartition" not in text


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("filter_age_lt_30", {"user_id"}),
        ("join_region_broadcast", {"event_id", "user_id"}),
        ("binary_to_hex", {"p_partkey", "p_name", "p_type"}),
        ("batch_counts", {"event_id"}),
        ("gen_suit", {"event_id", "ts"}),
    ],
)
def test_only_needed_columns_are_read(spark, data, name, columns):
    assert columns in reads(plan(QUERIES[name](spark, data)))


def test_predicates_reach_the_scan(spark, data):
    text = plan(inputs.region_changes(spark, data))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(event_type,error\)", text)


@pytest.mark.parametrize("name", ["price_table", "compact_with_deletes", "counter_survivors"])
def test_fixed_width_tables_are_hash_aggregates(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "partial_max_by" in text and "SortAggregate" not in text
    assert text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("name", ["latest_customer", "dedup_first", "dedup_epoch_latest"])
def test_wide_tables_combine_before_the_shuffle(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "partial_" in text and "Window" not in text


@pytest.mark.parametrize("name", ["price_lookup_shuffled", "join_region_inner_shuffled", "join_region_left_shuffled"])
def test_tables_beyond_the_bound_are_not_broadcast(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "SortMergeJoin" in text


def test_hot_join_keys_are_salted(spark, skewed):
    text = plan(QUERIES["join_region_inner_shuffled"](spark, skewed))
    assert re.search(r"Exchange hashpartitioning\(_key#\d+, _salt#\d+", text)


def test_one_exchange_numbers_all_repeats(spark, data):
    assert plan(QUERIES["dedup_epoch_join"](spark, data)).count("Exchange hashpartitioning") == 1


def test_rows_of_hot_keys_move_once(spark, skewed):
    """They find their segment where they are, by broadcast cut points, and are hashed by (key, segment)."""
    from pyspark.sql import functions as F

    from keytide.operators import ordered

    log = inputs.customers(spark, skewed)
    hot = ordered.hot_keys(log, ["region"], Limits(hot_rows=20))
    cut = ordered.in_segments(log, ["region"], ["off"], hot, Limits(hot_rows=20, segment_rows=30))
    scope = ordered.Scope(["region"], ["off"], segmented=True)
    text = plan(ordered.numbered("n").local(cut, scope))
    assert "rangepartitioning" not in text and text.count("Exchange hashpartitioning") == 1
    assert re.search(r"Exchange hashpartitioning\(region#\d+, _segment#\d+", text)
    sizes = [r["count"] for r in cut.groupBy("region", "_segment").count().collect()]
    assert max(sizes) <= 45 and len(sizes) > 20
    bounds = cut.groupBy("region", "_segment").agg(F.min("off").alias("low"), F.max("off").alias("high")).orderBy("region", "_segment").collect()
    for one, other in zip(bounds, bounds[1:]):
        assert one.region != other.region or one.high < other.low


def test_carried_rows_beyond_the_bytes_are_not_broadcast(spark, skewed):
    from keytide.operators import ordered

    log = inputs.customers(spark, skewed)
    limits = Limits(broadcast_bytes=10, hot_rows=20, segment_rows=30)
    done = ordered.apply_in_order(log, ["region"], ["off"], ordered.numbered("n"), limits)
    text = plan(done)
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    assert done.groupBy("region").agg({"n": "max", "*": "count"}).where("`max(n)` <> `count(1)`").isEmpty()


def test_as_of_with_few_versions_does_not_move_the_stream(spark, data):
    from keytide.operators import asof

    changes = inputs.region_changes(spark, data)
    joined = asof.join_as_of(
        inputs.customers(spark, data), changes, "region", "identifier", ["areaCode"], "left", Limits(versions_per_key=10_000)
    )
    text = plan(joined)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "last(" not in text


@pytest.mark.parametrize("name", ["join_region_asof_inner", "join_region_asof_left", "join_region_asof_deletes"])
def test_registered_as_of_joins_do_not_move_the_stream(spark, data, name):
    text = plan(QUERIES[name](spark, data))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text and "rangepartitioning" not in text


def test_size_check_reads_no_more_than_the_bound(spark):
    """The rows beyond the bound would fail if they were read."""
    table = spark.range(0, 100_000, 1, 1).selectExpr("if(id < 50, id, cast(raise_error('read too far') AS bigint)) AS x")
    assert not joins.fits_broadcast(table, Limits(broadcast_rows=10))


def test_table_size_is_measured(spark):
    table = spark.range(100)
    assert joins.fits_broadcast(table)
    assert not joins.fits_broadcast(table, Limits(broadcast_rows=99))
    assert not joins.fits_broadcast(table, Limits(broadcast_bytes=100))
    assert joins.fits_broadcast(table.where("id < 0"), Limits(broadcast_rows=0))


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_folder(spark, "x").startswith(shared_folder(spark))
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_latest_by_key_of_a_struct_order(spark):
    log = spark.createDataFrame([(1, 2, 3, 4)], "key int, value int, off bigint, ts bigint")
    assert tables.latest_by_key(log, ["key"], ["value"], ["ts", "off"]).first()[:] == (1, 2)


def test_only_a_local_master_may_lack_the_folder():
    from types import SimpleNamespace

    def session(master):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)

    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_repeated_table_rows_follow_the_hot_rows(spark):
    """A key of n rows has n / salt_rows pieces, the other keys one."""
    from pyspark.sql import functions as F

    log = spark.range(1000).select(F.when(F.col("id") < 400, 1).otherwise(F.col("id")).alias("key"), F.col("id").alias("off"))
    table = spark.range(1000).select(F.col("id").alias("id"), F.col("id").alias("value"))
    limits = Limits(broadcast_rows=0, hot_rows=100, salt_rows=40)
    joined = joins.lookup(log, table, F.col("key"), "id", "inner", limits)
    text = plan(joined)
    assert "SortMergeJoin" in text and "_salt" in text
    assert joined.count() == 1000 and joined.where("key <> value").isEmpty()
