"""Streams give what batches give, whatever the micro-batches, and survive restarts and replays."""

from __future__ import annotations

import json
import time

import pytest
from pyspark.sql import functions as F

from keytide.functions.regions import region_table
from keytide.operators import asof, dedup, joins, tables
from keytide.plans import inputs
from keytide.schemas import CUSTOMER, EVENTS
from keytide.settings import Limits, new_folder
from keytide.sinks import batches, logs
from keytide.sources import topics
from keytide.streaming import fold, state

FIELDS = CUSTOMER.fieldNames()


@pytest.fixture(scope="module", autouse=True)
def rocksdb(spark):
    state.use_rocksdb(spark)


@pytest.fixture(scope="module")
def parts(spark, skewed, tmp_path_factory):
    """The skewed events as five files that arrive in order."""
    folder = tmp_path_factory.mktemp("parts")
    events = spark.read.parquet(f"{skewed}/events.parquet").toPandas().sort_values("event_id")
    for i in range(5):
        events.iloc[i * 200 : (i + 1) * 200].sample(frac=1, random_state=i).to_parquet(folder / f"{i}.parquet", coerce_timestamps="us", index=False)
        time.sleep(1.1)
    return str(folder)


def events(spark, parts, **bounds):
    return topics.stream_log(spark, parts, EVENTS, **bounds)


def batch_customers(spark, parts):
    return inputs.as_customers(topics.read_log(spark, parts, EVENTS))


def finish(query):
    """Wait for the end of the input, but not for ever."""
    if not query.awaitTermination(120):
        query.stop()
        raise AssertionError("the query did not end")
    return query


def appended(spark, stream):
    root = new_folder(spark, "test")
    finish(logs.append_log(stream, f"{root}/log", f"{root}/checkpoint"))
    return spark.read.schema(stream.schema).parquet(f"{root}/log")


def rows(df, *columns):
    return sorted(map(tuple, df.select(*(columns or sorted(df.columns))).collect()), key=repr)


ONE_FILE = {"files_per_batch": 1}


@pytest.mark.parametrize("bounds", [{}, ONE_FILE, {"bytes_per_batch": 30_000}], ids=["one", "five", "bytes"])
def test_flag_repeats(spark, parts, bounds):
    stream = state.flag_repeats(inputs.as_customers(events(spark, parts, **bounds)))
    assert rows(appended(spark, stream)) == rows(dedup.flag_repeats(batch_customers(spark, parts)))


@pytest.mark.parametrize("bounds", [{}, ONE_FILE], ids=["one", "five"])
def test_count_repeats(spark, parts, bounds):
    stream = state.count_repeats(inputs.as_customers(events(spark, parts, **bounds)), CUSTOMER)
    assert rows(appended(spark, stream)) == rows(dedup.count_repeats(batch_customers(spark, parts), FIELDS))


def test_count_repeats_of_other_identities(spark, parts):
    """Keyed by region, so that stored records are replaced all the time, across batches too."""
    rekey = lambda df: df.withColumn("key", F.col("region"))
    stream = state.count_repeats(rekey(inputs.as_customers(events(spark, parts, **ONE_FILE))), CUSTOMER)
    want = dedup.count_repeats(rekey(batch_customers(spark, parts)), FIELDS)
    assert rows(appended(spark, stream)) == rows(want)


def test_flag_repeats_with_ttl(spark, parts):
    """With a time-to-live the query goes on, to expire keys; it is stopped once all is written."""
    stream = state.flag_repeats(inputs.as_customers(events(spark, parts)), ttl_ms=3_600_000)
    root = new_folder(spark, "test")
    query = logs.append_log(stream, f"{root}/log", f"{root}/checkpoint", once=False)
    deadline = time.time() + 60
    while not any(p["numInputRows"] for p in query.recentProgress) and time.time() < deadline:
        time.sleep(0.5)
    query.stop()
    written = spark.read.schema(stream.schema).parquet(f"{root}/log")
    assert rows(written) == rows(dedup.flag_repeats(batch_customers(spark, parts)))


SPLIT = Limits(broadcast_rows=0, hot_rows=20, segment_rows=30)


@pytest.mark.parametrize(("key", "limits"), [("key", Limits()), ("region", SPLIT)], ids=["plain", "split"])
def test_fold_equals_batch(spark, parts, key, limits):
    """Five batches with a state table in between; keyed by region, records replace each other."""
    rekey = lambda df: df.withColumn("key", F.col(key))
    stream, whole = rekey(inputs.as_customers(events(spark, parts, **ONE_FILE))), rekey(batch_customers(spark, parts))
    root = new_folder(spark, "test")
    finish(fold.count_repeats(stream, root, CUSTOMER, limits=limits))
    assert rows(fold.read_log(spark, root, stream.schema)) == rows(dedup.count_repeats(whole, FIELDS))
    root = new_folder(spark, "test")
    finish(fold.flag_repeats(stream, root, limits=limits))
    assert rows(fold.read_log(spark, root, stream.schema)) == rows(dedup.flag_repeats(whole))


@pytest.mark.parametrize("pace", [(1, 1), (1, 5), (5, 1), (2, 1)], ids=["even", "changes-ahead", "stream-ahead", "stream-faster"])
def test_join_to_a_changing_table(spark, parts, pace):
    """The same rows whatever the batches, also when one stream is read faster than the other."""
    whole = inputs.as_region_changes(topics.read_log(spark, parts, EVENTS))
    for how, late in (("inner", "3650 days"), ("left", "30 days")):
        customers = inputs.as_customers(events(spark, parts, files_per_batch=pace[0]))
        changes = inputs.as_region_changes(events(spark, parts, files_per_batch=pace[1]))
        running = fold.join_changing_table(
            customers, changes, new_folder(spark, "test"), "region", "identifier", ["regionName", "areaCode"], how,
            late_rows=late,
        )
        finish(running.query)
        want = asof.join_as_of(batch_customers(spark, parts), whole, "region", "identifier", ["regionName", "areaCode"], how)
        assert rows(running.read()) == rows(want)


def test_first_of_key_is_the_first(spark, parts):
    stream, root = inputs.as_customers(events(spark, parts, **ONE_FILE)), new_folder(spark, "test")
    finish(fold.keep_first(stream, root))
    assert rows(fold.read_log(spark, root, stream.schema)) == rows(dedup.keep_first(batch_customers(spark, parts)))


def test_fold_replays_a_failed_batch(spark, parts, monkeypatch):
    stream, root = inputs.as_customers(events(spark, parts, **ONE_FILE)), new_folder(spark, "test")
    real, calls = fold.batches.commit, []

    def commit(session, folder, batch_id, *told):
        calls.append(batch_id)
        if calls == [0, 1, 2]:
            raise RuntimeError("stop")
        real(session, folder, batch_id, *told)

    monkeypatch.setattr(fold.batches, "commit", commit)
    with pytest.raises(Exception, match="stop"):
        finish(fold.count_repeats(stream, root, CUSTOMER))
    assert fold.read_log(spark, root, stream.schema).count() == 400
    finish(fold.count_repeats(stream, root, CUSTOMER))
    assert calls == [0, 1, 2, 2, 3, 4]
    assert rows(fold.read_log(spark, root, stream.schema)) == rows(dedup.count_repeats(batch_customers(spark, parts), FIELDS))


def test_latest_repeat_in_update_mode(spark, parts):
    newest = dedup.latest_repeat(inputs.as_customers(events(spark, parts, **ONE_FILE)), FIELDS)
    root = new_folder(spark, "test")
    finish(batches.start_batches(newest, root, batches.fan_out("t"), output_mode="update"))
    written = batches.read_committed(spark, root, "t", newest.schema)
    assert written.select("batch_id").distinct().count() == 5
    folded = tables.latest_by_key(written, ["key"], FIELDS, ["batch_id"])
    assert rows(folded) == rows(dedup.latest_repeat(batch_customers(spark, parts), FIELDS))


def test_table_changes_and_deletes_in_update_mode(spark, parts):
    def table(df):
        points = df.select(F.col("user_id").alias("key"), F.col("value"), F.col("event_id").alias("off"), "event_type")
        return tables.latest_with_deletes(points, ["key"], ["value", "off"], F.col("event_type") == "error")

    updates = table(events(spark, parts, **ONE_FILE))
    root = new_folder(spark, "test")
    finish(batches.start_batches(updates, root, batches.fan_out("t"), output_mode="update"))
    written = batches.read_committed(spark, root, "t", updates.schema)
    per_batch = written.groupBy("batch_id", "key").count()
    assert per_batch.where("count > 1").isEmpty(), "one row per key and batch"
    folded = tables.latest_by_key(written, ["key"], ["value", "off", "is_deleted"], ["batch_id"])
    assert rows(folded) == rows(table(topics.read_log(spark, parts, EVENTS)))


def test_replicated_join_on_a_stream(spark, parts):
    regions = region_table(spark).where("identifier <> 'UK'")
    stream = joins.join_region_left(inputs.as_customers(events(spark, parts, **ONE_FILE)), regions)
    assert rows(appended(spark, stream)) == rows(joins.join_region_left(batch_customers(spark, parts), regions))


def test_duplicates_drop_with_and_without_watermark(spark, parts):
    people = inputs.as_customers(events(spark, parts, **ONE_FILE)).withColumn("ts", F.col("ts").cast("timestamp"))
    keys = rows(batch_customers(spark, parts).select("key").distinct())
    assert rows(appended(spark, dedup.keep_first_unbounded(people, "key")), "key") == keys
    assert rows(appended(spark, dedup.keep_first_within(people, "key", "ts", "60 days")), "key") == keys


def test_restart_resumes_without_loss_or_repeat(spark, parts, tmp_path):
    """Two runs over a growing folder give each record once, with state carried over."""
    source, root = tmp_path / "in", new_folder(spark, "test")
    source.mkdir()

    def run():
        stream = state.count_repeats(inputs.as_customers(events(spark, str(source))), CUSTOMER)
        finish(logs.append_log(stream, f"{root}/log", f"{root}/checkpoint"))
        return spark.read.schema(stream.schema).parquet(f"{root}/log")

    for i, count in ((0, 200), (1, 400), (1, 400), (2, 600)):
        data = open(f"{parts}/{i}.parquet", "rb").read()
        if not (source / f"{i}.parquet").exists():
            (source / f"{i}.parquet").write_bytes(data)
        assert run().count() == count
    want = dedup.count_repeats(batch_customers(spark, parts).where("off < 600"), FIELDS)
    assert rows(run()) == rows(want)


def test_latest_start_sees_only_what_comes_later(spark, parts, tmp_path):
    source, root = tmp_path / "in", new_folder(spark, "test")
    source.mkdir()
    assert topics.end_of_log(spark.createDataFrame([], "off bigint")) == 0

    def arrive(i):
        (source / f"{i}.parquet").write_bytes(open(f"{parts}/{i}.parquet", "rb").read())

    arrive(0)
    arrive(1)
    start = topics.end_of_log(topics.read_log(spark, str(source), EVENTS), "event_id")
    for i in (None, 2, 3):
        if i:
            arrive(i)
        stream = events(spark, str(source), start=start, position="event_id")
        finish(logs.append_log(stream, f"{root}/log", f"{root}/checkpoint"))
    seen = spark.read.schema(EVENTS).parquet(f"{root}/log")
    assert sorted(r.event_id for r in seen.select("event_id").collect()) == list(range(400, 800))


def test_fan_out_writes_both(spark, parts):
    root = new_folder(spark, "test")
    stream = inputs.as_customers(events(spark, parts, **ONE_FILE))
    finish(batches.start_batches(stream, root, batches.fan_out("a", "b")))
    want = rows(batch_customers(spark, parts))
    for name in ("a", "b"):
        assert rows(batches.read_committed(spark, root, name, stream.schema).drop("batch_id")) == want


def test_replayed_batch_writes_nothing(spark):
    root, one = new_folder(spark, "test"), spark.range(3)
    assert batches.write_atomically(root, 0, {"a": one, "b": one})
    assert not batches.write_atomically(root, 0, {"a": spark.range(9), "b": one})
    assert batches.read_committed(spark, root, "a", one.schema).count() == 3


def test_half_written_batch_is_invisible_and_replaced(spark):
    root, one = new_folder(spark, "test"), spark.range(3)
    batches.write_atomically(root, 0, {"a": one, "b": one})
    failing = spark.range(2).select(F.raise_error(F.lit("stop")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="stop"):
        batches.write_atomically(root, 1, {"a": spark.range(100), "b": failing})
    assert batches.read_committed(spark, root, "a", one.schema).count() == 3
    assert batches.write_atomically(root, 1, {"a": spark.range(5), "b": spark.range(7)})
    assert batches.read_committed(spark, root, "a", one.schema).count() == 8
    assert batches.read_committed(spark, root, "b", one.schema).count() == 10


def test_failed_stream_batch_is_retried_whole(spark, parts):
    """A query that dies between two sinks finishes both on restart, without repeats."""
    root, seen = new_folder(spark, "test"), []
    stream = inputs.as_customers(events(spark, parts, **ONE_FILE))

    def split(batch):
        seen.append(1)
        broken = batch.withColumn("off", F.raise_error(F.lit("stop")).cast("bigint"))
        return {"a": batch, "b": broken if len(seen) == 3 else batch}

    with pytest.raises(Exception, match="stop"):
        finish(batches.start_batches(stream, root, split))
    assert batches.read_committed(spark, root, "a", stream.schema).count() == 400
    finish(batches.start_batches(stream, root, split))
    for name in ("a", "b"):
        assert rows(batches.read_committed(spark, root, name, stream.schema).drop("batch_id")) == rows(
            batch_customers(spark, parts)
        )


def test_counts_are_observed(spark, parts):
    root = new_folder(spark, "test")
    stream = logs.counted(events(spark, parts, **ONE_FILE), "seen")
    query = finish(logs.append_log(stream, f"{root}/log", f"{root}/checkpoint"))
    observed = [json.loads(progress.json)["observedMetrics"] for progress in query.recentProgress]
    assert [metrics["seen"]["records"] for metrics in observed if metrics] == [200] * 5
