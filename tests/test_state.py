"""Commit logs, state in buckets, expiry, the live table, counts and bounded readers."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from keytide.operators import asof, dedup
from keytide.plans import inputs
from keytide.schemas import CUSTOMER, EVENTS
from keytide.settings import Limits, new_folder
from keytide.sinks import batches, commits
from keytide.sources import topics
from keytide.streaming import fold, replica, store

ROW = "key long, off long, ts timestamp"


def finish(query):
    if not batches.end(query, 120):
        query.stop()
        raise AssertionError("the query did not end")
    return query


def tuples(df, *columns):
    return sorted(map(tuple, df.select(*(columns or sorted(df.columns))).collect()), key=repr)


def arrive(spark, folder, made, schema=ROW):
    """One more file for a stream."""
    spark.createDataFrame(made, schema).coalesce(1).write.mode("append").parquet(folder)


def moment(seconds):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


# --- commits -------------------------------------------------------------------------------


def test_a_reader_lists_few_files(spark, monkeypatch):
    """However many batches: few commit files, few folders, every row once."""
    monkeypatch.setattr(batches, "MERGE", 3)
    monkeypatch.setattr(commits, "SNAPSHOT_EVERY", 5)
    root, most_commits, most_folders, written = new_folder(spark, "log"), 0, 0, 40
    for number in range(written):
        one = spark.range(number, number + 1, 1, 1)
        assert batches.write_atomically(root, number, {"t": one}, counted=number % 2 == 0)
        most_commits = max(most_commits, len(commits.names(spark, f"{root}/commits")))
        most_folders = max(most_folders, len(commits.read(spark, root).folders["t"]))
    assert most_commits <= 4 * commits.SNAPSHOT_EVERY and most_folders <= 4 * 3
    assert len(commits.names(spark, f"{root}/t")) <= most_folders + 4
    got = batches.read_committed(spark, root, "t", spark.range(1).schema)
    assert tuples(got, "id", "batch_id") == sorted(((i, i) for i in range(written)), key=repr)
    assert commits.read(spark, root).ranges == [[0, written - 1]] and batches.taken(spark, root) == written
    counts = batches.read_counts(spark, root)
    assert tuples(counts, "batch_id", "records") == sorted(((i, 1) for i in range(0, written, 2)), key=repr)
    assert not batches.write_atomically(root, 3, {"t": spark.range(9)})


def test_numbers_may_have_gaps(spark):
    root = new_folder(spark, "log")
    for number in (5, 0, 2, 1):
        batches.write_atomically(root, number, {"t": spark.range(1)})
    state = commits.read(spark, root)
    assert state.ranges == [[0, 2], [5, 5]] and 4 not in state and state.last == 5


def test_a_second_writer_is_refused(spark):
    root = new_folder(spark, "log")
    commits.add(spark, root, 0)
    with pytest.raises(RuntimeError, match="two writers"):
        commits._write(spark, f"{root}/commits/{0:020d}.commit", {})


def test_an_empty_root(spark):
    root = new_folder(spark, "none")
    assert batches.last_committed(spark, root) is None and batches.taken(spark, root) == 0
    assert batches.read_committed(spark, root, "t", spark.range(1).schema).collect() == []
    assert batches.write_atomically(root, 0, {"t": spark.range(0)}, counted=True)
    assert [r.records for r in batches.read_counts(spark, root).collect()] == [0]


# --- state in buckets ----------------------------------------------------------------------


def files(root):
    return {
        os.path.relpath(os.path.join(folder, name), f"{root}/state")
        for folder, _, names in os.walk(f"{root}/state")
        for name in names
        if name.endswith(".parquet")
    }


def test_only_touched_buckets_are_written(spark):
    source, root = new_folder(spark, "in"), new_folder(spark, "fold")
    schema = "key long, customerId long, firstName string, epoch int, off long"
    fields = spark.createDataFrame([], "customerId long, firstName string, epoch int").schema

    def run(made):
        arrive(spark, source, made, schema)
        stream = spark.readStream.schema(schema).parquet(source)
        finish(fold.count_repeats(stream, root, fields, buckets=8))
        return stream

    made = [(k, k, f"n{k}", 1, k) for k in range(100)]
    run(made)
    first = files(root)
    assert len(first) == 8
    for more in range(3):
        extra = [(7, 7, "other", 1, 100 + more)]
        stream = run(extra)
        made += extra
        new = files(root) - first
        assert len(new) == more + 1 and first <= files(root)
    log = spark.createDataFrame(made, schema)
    assert tuples(fold.read_log(spark, root, stream.schema)) == tuples(dedup.count_repeats(log, fields.fieldNames()))


@pytest.mark.parametrize("operator", ["count", "flag", "first"])
def test_many_batches_merge_pieces(spark, monkeypatch, operator):
    """Buckets are written anew as pieces gather; old pieces go; results equal the batch operator."""
    monkeypatch.setattr(store, "PIECES", 2)
    source, root, draw = new_folder(spark, "in"), new_folder(spark, "fold"), random.Random(3)
    schema = "key long, customerId long, firstName string, epoch int, off long"
    fields = spark.createDataFrame([], "customerId long, firstName string, epoch int").schema
    made = [(draw.choice([None, draw.randrange(12)]), draw.randrange(3), f"n{i}", 1, i) for i in range(160)]
    for i in range(8):
        arrive(spark, source, made[i * 20 : i * 20 + 20], schema)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    log = spark.createDataFrame(made, schema)
    if operator == "count":
        finish(fold.count_repeats(stream, root, fields, buckets=3))
        want = dedup.count_repeats(log, fields.fieldNames())
    elif operator == "flag":
        finish(fold.flag_repeats(stream, root, buckets=3))
        want = dedup.flag_repeats(log)
    else:
        finish(fold.keep_first(stream, root, buckets=3))
        want = dedup.keep_first(log)
    # The file source may order files of one second as it likes, so compare by what batches saw.
    got = fold.read_log(spark, root, stream.schema)
    if operator == "first":
        assert tuples(got, "key") == tuples(want, "key")
    else:
        by_key = lambda df: tuples(df.groupBy("key").agg(F.sum("epoch"), F.count("*")))
        assert got.count() == 160 and (operator == "count" or by_key(got) == by_key(want))
    assert len(files(root)) <= 3 * (2 + 2 + 2)


# --- expiry --------------------------------------------------------------------------------


def test_keys_pass_again_in_the_next_span(spark):
    source, root, draw = new_folder(spark, "in"), new_folder(spark, "spans"), random.Random(5)
    made, kept = [], []
    for day in range(12):
        batch = [(draw.choice([None, *range(6)]), day * 30 + i, moment(day * 86400 + i * 2000)) for i in range(30)]
        made += batch
        arrive(spark, source, batch)
        stream = spark.readStream.schema(ROW).parquet(source)
        finish(fold.keep_first_per_span(stream, root, "2 days", late="1 hour", buckets=2))
        kept.append(len([name for name in commits.names(spark, f"{root}/state")]))
    first = {}
    for key, off, ts in made:
        first.setdefault((key, int((ts - dt.datetime(1970, 1, 1)).total_seconds()) // (2 * 86400)), off)
    got = [r.off for r in fold.read_log(spark, root, stream.schema).collect()]
    assert sorted(got) == sorted(first.values())
    assert max(kept) <= 3, "the keys of past spans are dropped"


def test_late_and_timeless_records_do_not_pass(spark):
    source, root = new_folder(spark, "in"), new_folder(spark, "spans")
    day = 86400
    for made in ([(1, 0, moment(0)), (2, 1, None)], [(1, 2, moment(5 * day))], [(3, 3, moment(0)), (3, 4, moment(5 * day))]):
        arrive(spark, source, made)
        stream = spark.readStream.schema(ROW).parquet(source)
        finish(fold.keep_first_per_span(stream, root, "1 day", late="1 day"))
    assert sorted(r.off for r in fold.read_log(spark, root, stream.schema).collect()) == [0, 2, 4]


# --- versions of a changing table ----------------------------------------------------------


def test_versions_of_a_changing_table_are_bounded(spark, monkeypatch):
    """A long run keeps the current version of each key and the newest ones, not all."""
    monkeypatch.setattr(store, "PIECES", 2)
    schema = "side int, key long, value string, off long, ts timestamp"
    source, root, made, draw = new_folder(spark, "in"), new_folder(spark, "changing"), [], random.Random(8)
    sizes = []
    for number in range(12):
        batch = [
            (draw.randrange(2), draw.randrange(4), f"v{number}-{i}", number * 20 + i, moment(number * 1000 + i * 10)) for i in range(20)
        ]
        made += batch
        arrive(spark, source, batch, schema)
        log = spark.readStream.schema(schema).parquet(source)
        people = log.where("side = 0").select(F.col("key").alias("region"), "off", "ts")
        changes = log.where("side = 1").select(F.col("key").alias("id"), "value", "off", "ts")
        running = fold.join_changing_table(
            people, changes, root, "region", "id", ["value"], "left", late_rows="100 seconds", buckets=2
        )
        finish(running.query)
        told = commits.read(spark, root).note["state"]
        held = store.Store(spark, f"{root}/state", spark.createDataFrame([], "id long, value string, ts timestamp, off long").schema, "id", told)
        sizes.append(held.read([0, 1]).count())
    whole = spark.createDataFrame(made, schema)
    want = asof.join_as_of(
        whole.where("side = 0").select(F.col("key").alias("region"), "off", "ts"),
        whole.where("side = 1").select(F.col("key").alias("id"), "value", "off", "ts"),
        "region", "id", ["value"], "left",
    )
    assert tuples(running.read()) == tuples(want)
    assert max(sizes[6:]) <= 4 + 4 * 20 < sum(1 for row in made if row[0] == 1)


# --- the live table ------------------------------------------------------------------------


def test_a_running_stream_sees_a_newer_table(spark, monkeypatch):
    """The table changes while one query runs; it is measured once per version, and a replay meets the version it met."""
    source, root, tables = (new_folder(spark, name) for name in ("in", "live", "tables"))
    schema = spark.createDataFrame([], "id long, name string").schema
    for i in range(4):
        arrive(spark, source, [(k, i * 3 + k, moment(i)) for k in range(3)])
    replica.publish(spark.createDataFrame([(0, "a0"), (1, "b0"), (None, "none")], schema), tables)
    measured, calls = [], []
    real_fits, real_write = replica.joins.fits_broadcast, replica.batches.write_atomically

    def fits(table, limits):
        measured.append(1)
        return real_fits(table, limits)

    def write(folder, number, made):
        calls.append(number)
        if calls == [0, 1, 2]:
            replica.publish(spark.createDataFrame([(0, "lost")], schema), tables)
            raise RuntimeError("stop")
        done = real_write(folder, number, made)
        if number == 1:
            replica.publish(spark.createDataFrame([(0, "a1"), (2, "c1")], schema), tables)
        return done

    monkeypatch.setattr(replica.joins, "fits_broadcast", fits)
    monkeypatch.setattr(replica.batches, "write_atomically", write)

    def run():
        stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(source)
        finish(replica.start_lookup(stream, root, tables, schema, F.col("key"), "id", "left"))
        return spark.createDataFrame([], f"{ROW}, name string").schema

    with pytest.raises(Exception, match="stop"):
        run()
    assert len(measured) == 2, "two versions, three batches"
    out = replica.read(spark, root, run())
    by_version = {}
    for r in out.collect():
        by_version.setdefault(r.table_version, set()).add((r.key, r.name))
    assert by_version == {
        0: {(0, "a0"), (1, "b0"), (2, None)},
        1: {(0, "a1"), (1, None), (2, "c1")},
        2: {(0, "lost"), (1, None), (2, None)},
    }
    assert out.count() == 12 and out.where("table_version = 0").count() == 6
    assert replica.newest(spark, tables) == 2


def test_before_the_first_version_nothing_matches(spark):
    source, root = new_folder(spark, "in"), new_folder(spark, "live")
    schema = spark.createDataFrame([], "id long, name string").schema
    arrive(spark, source, [(1, 1, moment(0))])
    stream = spark.readStream.schema(ROW).parquet(source)
    finish(replica.start_lookup(stream, root, new_folder(spark, "none"), schema, F.col("key"), "id", "left"))
    got = replica.read(spark, root, spark.createDataFrame([], f"{ROW}, name string").schema).collect()
    assert [(r.name, r.table_version) for r in got] == [(None, -1)]


def test_tables_beyond_the_bound_are_joined_by_shuffle(spark):
    source, root, tables = (new_folder(spark, name) for name in ("in", "live", "tables"))
    schema = spark.createDataFrame([], "id long, name string").schema
    arrive(spark, source, [(k % 5, k, moment(k)) for k in range(60)])
    replica.publish(spark.createDataFrame([(k, f"n{k}") for k in range(4)], schema), tables)
    stream = spark.readStream.schema(ROW).parquet(source)
    limits = Limits(broadcast_rows=0, hot_rows=5, salt_rows=4)
    finish(replica.start_lookup(stream, root, tables, schema, F.col("key"), "id", limits=limits))
    got = replica.read(spark, root, spark.createDataFrame([], f"{ROW}, name string").schema)
    assert got.count() == 48 and got.where("name <> concat('n', key)").isEmpty()


# --- bounded readers and counts ------------------------------------------------------------


def test_a_bounded_reader_stops_and_goes_on(spark):
    source, root = new_folder(spark, "in"), new_folder(spark, "bounded")
    for i in range(6):
        arrive(spark, source, [(k, i * 10 + k, moment(i)) for k in range(10)])

    def run(most, staged):
        stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(source)
        finish(batches.start_batches(stream, root, batches.fan_out("a", "b"), stop_after=most, staged=staged))
        return batches.read_committed(spark, root, "a", stream.schema).count()

    assert run(9, True) == 10  # more than 9 after one batch
    assert run(10, True) == 20  # 10 is not more than 10
    assert run(35, False) == 40
    assert run(35, True) == 40, "nothing more to take"
    assert run(0, True) == 60, "no bound"
    got = batches.read_committed(spark, root, "b", spark.createDataFrame([], ROW).schema)
    assert sorted(r.off for r in got.collect()) == list(range(60))


def test_counts_outlast_progress_and_restarts(spark):
    """Over a hundred batches in two runs; the kept progress alone would forget some."""
    source, root = new_folder(spark, "in"), new_folder(spark, "counts")
    spark.range(0, 1010, 1, 101).select(F.col("id").alias("off")).write.parquet(source)

    def run():
        stream = spark.readStream.schema("off long").option("maxFilesPerTrigger", 1).parquet(source)
        finish(batches.start_batches(stream, root, batches.fan_out("t"), staged=False, counted=True))

    run()
    spark.range(1010, 1030, 1, 2).select(F.col("id").alias("off")).write.mode("append").parquet(source)
    run()
    counts = batches.read_counts(spark, root)
    assert counts.count() == 103 and counts.agg(F.sum("records")).first()[0] == 1030 == batches.taken(spark, root)
