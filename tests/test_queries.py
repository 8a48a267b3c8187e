"""Every registered query equals its SQL, on the given tables and on skewed ones."""

import pytest
from compare import database, differences

from keytide.plans.oracles import ORACLES
from keytide.plans.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, data, name):
    assert differences(QUERIES[name](spark, data), database(data), ORACLES[name]) == []


_SKEWED = [
    "price_table",
    "price_lookup_broadcast",
    "price_lookup_shuffled",
    "price_table_changes",
    "compact_with_deletes",
    "counter_survivors",
    "batch_counts",
    "join_region_inner",
    "join_region_inner_shuffled",
    "join_region_left_shuffled",
    "join_region_asof_left",
    "join_region_asof_segmented",
    "join_region_asof_deletes",
    "stream_region_changing",
    "stream_dedup_keys",
    "dedup_first",
    "dedup_epoch_flag",
    "dedup_epoch_flag_shuffled",
    "dedup_epoch_join",
    "dedup_epoch_join_segmented",
    "dedup_epoch_latest",
    "stream_epoch_flag",
    "stream_epoch_join",
    "stream_epoch_latest",
    "fan_out_two",
    "scan_generic",
    "fold_epoch_flag",
    "fold_epoch_join",
    "stream_bounded",
    "stream_dedup_weekly",
    "join_region_live",
]


@pytest.mark.parametrize("name", _SKEWED)
def test_skewed_tables_equal_sql(spark, skewed, name):
    assert differences(QUERIES[name](spark, skewed), database(skewed), ORACLES[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_contract(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql()) <= set(driver.queries())
