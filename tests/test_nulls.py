"""Nulls, ties, deletes and clashing or missing offsets give one result in every form of an operator."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from keytide.operators import asof, dedup, filters, joins, tables
from keytide.settings import Limits

EARLY = Limits(broadcast_rows=0, hot_rows=5, segment_rows=4, salt_rows=3)
START = datetime(2024, 1, 1)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


@pytest.fixture(scope="module")
def sides(spark):
    """A stream and a change log with null keys and times, ties, deletes and null delete marks."""
    draw = random.Random(1)
    moment = lambda: None if draw.random() < 0.1 else START + timedelta(seconds=draw.randrange(60))
    key = lambda: None if draw.random() < 0.1 else draw.choice("abc")
    stream = [(key(), i, moment()) for i in range(150)]
    changes = [(key(), f"v{i}", draw.choice([True, False, False, None]), i, moment()) for i in range(60)]
    return (
        spark.createDataFrame(stream, "key string, off long, ts timestamp"),
        spark.createDataFrame(changes, "id string, value string, gone boolean, off long, ts timestamp"),
    )


def brute(stream, changes, how, deletes):
    out = []
    for row in stream.collect():
        known = [c for c in changes.collect() if c.id == row.key is not None and c.ts and row.ts and c.ts <= row.ts]
        newest = max(known, key=lambda c: (c.ts, c.off), default=None)
        live = newest is not None and not (deletes and newest.gone)
        if live or how == "left":
            out.append((row.key, row.off, row.ts, newest.value if live else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("deletes", [True, False])
def test_all_forms_of_the_as_of_join_agree(spark, sides, how, deletes):
    stream, changes = sides
    want = brute(stream, changes, how, deletes)
    mark = F.col("gone") if deletes else None
    forms = (Limits(), Limits(versions_per_key=1000, broadcast_rows=70), Limits(versions_per_key=0), EARLY)
    for limits in forms:
        joined = asof.join_as_of(stream, changes, "key", "id", ["value"], how, limits, mark)
        got = sorted(map(tuple, joined.select("key", "off", "ts", "value").collect()), key=repr)
        assert got == want, limits


def test_as_of_an_empty_table(spark, sides):
    stream, changes = sides
    none = changes.limit(0)
    assert asof.join_as_of(stream, none, "key", "id", ["value"]).count() == 0
    assert asof.join_as_of(stream, none, "key", "id", ["value"], "left").count() == stream.count()


@pytest.mark.parametrize("limits", [Limits(), EARLY], ids=["broadcast", "shuffled"])
def test_flags_keep_every_row_whatever_the_offsets(spark, limits):
    """Offsets that two partitions both use, null keys and null order columns."""
    data = [("a", 0, 1), ("b", 0, 1), ("a", 1, 1), ("b", 1, 1), (None, 1, 1), (None, 2, 1), ("c", None, 1), ("c", 3, 1)]
    log = spark.createDataFrame(data, "key string, off long, epoch int")
    got = sorted(((r.key, r.off, r.epoch) for r in dedup.flag_repeats(log, limits=limits).collect()), key=repr)
    later = {("a", 1), ("b", 1), (None, 2), ("c", None)}  # a row without a place comes last
    assert got == sorted(((k, o, 2 if (k, o) in later else 1) for k, o, _ in data), key=repr)


def test_flags_by_two_columns_with_nulls(spark):
    data = [("a", None, 5, 1), ("a", 3, 6, 1)]
    log = spark.createDataFrame(data, "key string, ts long, off long, epoch int")
    got = dedup.flag_repeats(log, order=["ts", "off"]).orderBy("off").collect()
    assert [r.epoch for r in got] == [1, 2]


def test_a_null_delete_mark_deletes_nothing(spark):
    log = spark.createDataFrame([("a", 1, 0, None), ("b", 2, 1, True), ("c", 3, 2, False)], "k string, v int, off long, d boolean")
    assert [r.k for r in tables.compact(log, ["k"], ["v"], F.col("d")).orderBy("k").collect()] == ["a", "c"]


def test_counts_do_not_need_dense_offsets(spark):
    log = spark.createDataFrame([(i * i + 7,) for i in range(10)], "off long")
    counts = [(r.batch, r.records, r.total) for r in tables.batch_counts(log, 4).orderBy("batch").collect()]
    assert counts == [(0, 4, 4), (1, 4, 8), (2, 2, 10)]
    assert filters.until_count(log, 5, 4).count() == 8
    assert filters.until_count(log, 500, 4).count() == 10


def test_salted_lookups_need_no_offsets(spark):
    stream = spark.createDataFrame([("a", i) for i in range(40)] + [("b", 1), (None, 2)], "k string, x int")
    table = spark.createDataFrame([("a", "A"), ("c", "C")], "id string, name string")
    found = joins.lookup(stream, table, F.col("k"), "id", "left", EARLY)
    assert found.count() == 42 and found.where("name = 'A'").count() == 40
