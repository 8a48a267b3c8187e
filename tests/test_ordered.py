"""Split keys give the same numbering, carrying and totals as one window per key."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from keytide.operators import asof, dedup, joins, ordered, tables
from keytide.settings import Limits


def log_of(spark, seed: int, rows: int = 600):
    draw = random.Random(seed)
    offs = draw.sample(range(10 * rows), rows)
    made = [
        (draw.choice([None, 1, 1, 1, 2, 3, draw.randrange(4, 60)]), off, draw.choice([None, None, draw.randrange(100)]))
        for off in offs
    ]
    return made, spark.createDataFrame(made, "key int, off bigint, value int").repartition(5)


def expected(made):
    by_key = {}
    for key, off, value in made:
        by_key.setdefault(key, []).append((off, value))
    out = {}
    for key, rows in by_key.items():
        last, total = None, None
        for n, (off, value) in enumerate(sorted(rows, key=lambda row: row[0]), 1):
            last = value if value is not None else last
            total = total if value is None else (total or 0) + value
            out[off] = (key, n, last, total)
    return out


STEPS = [
    ordered.numbered("n"),
    ordered.last_value("value", "last"),
    ordered.running_sum("value", "total"),
]


def each_local(rows, scope):
    for step in STEPS:
        rows = step.local(rows, scope)
    return rows


def each_finish(rows, ends, scope):
    for step in STEPS:
        rows = step.finish(rows, ends, scope)
    return rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize(
    "limits",
    [
        Limits(),
        Limits(hot_rows=50, segment_rows=40),
        Limits(hot_rows=1, segment_rows=7),
        Limits(hot_rows=1, hot_keys=5, segment_rows=100, segments=3),
    ],
    ids=["windows", "some-hot", "all-hot", "capped"],
)
def test_steps_equal_a_loop(spark, seed, limits):
    made, log = log_of(spark, seed)
    done = ordered.apply_in_order(log, ["key"], ["off"], ordered.Step(each_local, each_finish), limits)
    got = {r.off: (r.key, r.n, r["last"], r.total) for r in done.collect()}
    assert got == expected(made)


def test_without_keys_the_log_is_one_group(spark):
    log = spark.range(500).select((F.lit(499) - F.col("id")).alias("off"), F.col("id").alias("value")).repartition(7)
    for limits in (Limits(), Limits(hot_rows=10, segment_rows=30)):
        got = ordered.apply_in_order(log, [], ["off"], ordered.numbered("n"), limits).collect()
        assert sorted((r.off, r.n) for r in got) == [(i, i + 1) for i in range(500)]
        counts = tables.batch_counts(log, 30, limits).orderBy("batch").collect()
        assert [r.total for r in counts] == [min(500, 30 * (i + 1)) for i in range(17)]


def test_hot_keys_are_few(spark):
    _, log = log_of(spark, 1, 2000)
    limits = Limits(hot_rows=1, hot_keys=4)
    hot = ordered.hot_keys(log, ["key"], limits).collect()
    assert 0 < len(hot) <= 4 and all(r["_rows"] > 500 for r in hot)
    assert ordered.hot_keys(log, ["key"], Limits()) is None


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_equals_plain(spark, how):
    _, log = log_of(spark, 5)
    table = spark.range(1, 20).select(F.col("id").cast("int").alias("id"), (F.col("id") * 10).alias("found"))
    runs = [
        joins.lookup(log, table, F.col("key"), "id", how, limits)
        for limits in (
            Limits(),
            Limits(broadcast_rows=0),
            Limits(broadcast_rows=0, hot_rows=30, salt_rows=10),
            Limits(broadcast_bytes=1, hot_rows=1, salt_rows=2),
        )
    ]
    first, *others = [sorted(map(tuple, run.collect()), key=repr) for run in runs]
    assert len(first) > 100 and all(other == first for other in others)


@pytest.mark.parametrize("seed", range(2))
def test_as_of_forms_agree(spark, seed):
    made, log = log_of(spark, seed)
    _, other = log_of(spark, seed + 100, 300)
    stamp = lambda df: df.withColumn("ts", F.timestamp_seconds(F.col("off") % 500))
    stream, changes = stamp(log.drop("value")), stamp(other).withColumnRenamed("key", "id").withColumn("off", F.col("off") + 10**6)
    forms = [
        asof.join_as_of(stream, changes, "key", "id", ["value", "off"][:1], how, limits)
        for limits in (Limits(versions_per_key=1000), Limits(versions_per_key=0), Limits(versions_per_key=0, hot_rows=20, segment_rows=25))
        for how in ("left",)
    ]
    first, *others = [sorted(map(tuple, form.collect()), key=repr) for form in forms]
    assert len(first) == len(made) and all(form == first for form in others)


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=0, hot_rows=20, segment_rows=15)], ids=["plain", "split"])
def test_repeats_equal_a_loop(spark, limits):
    draw = random.Random(9)
    made = [(draw.choice([1, 1, 2, draw.randrange(30)]), draw.choice([1, 1, 1, 2]), f"n{i}", 1, i) for i in range(500)]
    log = spark.createDataFrame(made, "key bigint, customerId bigint, firstName string, epoch int, off bigint").repartition(6)
    stored, want = {}, []
    for key, customer, name, epoch, off in made:
        old = stored.get(key)
        stored[key] = (old[0], old[1], old[2] + 1) if old and old[0] == customer else (customer, name, epoch)
        want.append((key, *stored[key], off))
    got = dedup.count_repeats(log, ["customerId", "firstName", "epoch"], limits=limits).collect()
    assert sorted(map(tuple, got), key=lambda row: row[-1]) == want
