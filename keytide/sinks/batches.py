"""Micro-batches written to one or several tables, all or nothing.

Layout under a root folder: ``<table>/<name>/`` holds what a batch wrote to the table, and the commit log (``commits``) says
which of these folders count. Readers only open folders that are committed. A batch that
fails half-way leaves no commit and its replay writes the same folders again; a replay of a
committed batch writes nothing. ``MERGE`` folders of one size become one of the next, so that a table has few folders
however many batches there were; what they replace goes with the merge after. The root belongs to one query: it
also holds its checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from keytide.sinks import commits

STAGED, COUNTS = "staged", "_counts"
MERGE = 16
FILE_BYTES = 128 << 20
BATCH = "batch_id"
_BATCH = T.StructField(BATCH, T.LongType(), True)
_COUNT = T.StructType([T.StructField("table", T.StringType()), T.StructField("records", T.LongType())])


def write_atomically(root: str, batch_id: int, tables: dict[str, DataFrame], counted: bool = False, came: Observation | None = None) -> bool:
    """Write every table of a batch, then its commit. False if the batch was there already.

    ``counted`` keeps how many records went to each table in a table of counts, committed with them (see ``read_counts``).
    ``came`` has observed the batch's own records; without it those of the first table count as taken.
    """
    spark = next(iter(tables.values())).sparkSession
    if is_committed(spark, root, batch_id):
        return False
    written, seen = {}, {}
    for name, df in tables.items():
        seen[name] = Observation()
        written[name] = write_batch(df.observe(seen[name], F.count(F.lit(1)).alias("records")), root, name, batch_id)
    if counted:
        rows = [F.struct(F.lit(name).alias("table"), F.lit(one.get["records"]).alias("records")) for name, one in seen.items()]
        written[COUNTS] = write_batch(spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows))), root, COUNTS, batch_id)
    records = (came or next(iter(seen.values()))).get["records"]
    commit(spark, root, batch_id, written, {"taken": taken(spark, root) + records})
    return True


def write_batch(df: DataFrame, root: str, table: str, batch_id: int) -> str:
    """Write what a batch brings to a table; returns the folder to commit."""
    folder = f"0-{batch_id:012d}"
    df.withColumn(BATCH, F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{root}/{table}/{folder}")
    return folder


def commit(spark: SparkSession, root: str, batch_id: int, written: dict[str, str], note: dict | None = None) -> None:
    """Make what a batch wrote visible, and merge folders where there are enough of a size. A note replaces the last one."""
    state = commits.add(spark, root, batch_id, {table: [folder] for table, folder in written.items()}, note=note)
    for table in written:
        state = _merged(spark, root, table, state)


def _merged(spark: SparkSession, root: str, table: str, state: commits.Committed) -> commits.Committed:
    """Replace the oldest ``MERGE`` folders of a size by one. What the merge before replaced is deleted only now, so that
    readers have many commits' time to end."""
    by_size: dict[str, list[str]] = {}
    for name in sorted(state.folders[table]):
        by_size.setdefault(name.split("-")[0], []).append(name)
    for size, held in by_size.items():
        if len(held) < MERGE:
            continue
        paths = [f"{root}/{table}/{name}" for name in held[:MERGE]]
        files = max(1, -(-sum(commits.size(spark, path) for path in paths) // FILE_BYTES))
        name = f"{int(size) + 1}-{held[MERGE - 1].split('-')[1]}"
        spark.read.parquet(*paths).coalesce(files).write.mode("overwrite").parquet(f"{root}/{table}/{name}")
        left = state.gone.get(table, [])
        state = commits.add(spark, root, None, {table: [name]}, {table: held[:MERGE]})
        for old in left:
            commits.delete(spark, f"{root}/{table}/{old}")
    return state


def is_committed(spark: SparkSession, root: str, batch_id: int) -> bool:
    return batch_id in commits.read(spark, root)


def last_committed(spark: SparkSession, root: str) -> int | None:
    """The number of the newest batch with a commit."""
    return commits.read(spark, root).last


def _keyed(schema: T.StructType) -> T.StructType:
    return T.StructType([*[T.StructField(f.name, f.dataType, True) for f in schema], _BATCH])


def read_committed(spark: SparkSession, root: str, table: str, schema: T.StructType) -> DataFrame:
    """Rows of committed batches, with their ``batch_id``."""
    held = commits.read(spark, root).folders.get(table, [])
    if not held:
        return spark.createDataFrame([], _keyed(schema))
    return spark.read.schema(_keyed(schema)).parquet(*[f"{root}/{table}/{name}" for name in held])


def read_counts(spark: SparkSession, root: str) -> DataFrame:
    """Records by table and batch, of every committed batch that was counted."""
    return read_committed(spark, root, COUNTS, _COUNT)


def taken(spark: SparkSession, root: str) -> int:
    """Records of all committed batches, as taken from their source."""
    return commits.read(spark, root).note.get("taken", 0)


class Stopped(Exception):
    """A stream has all the records that were asked for."""


def end(query: StreamingQuery, seconds: float | None = None) -> bool:
    """Wait until a query is at its end, or has the records that ``stop_after`` asked for. False if time ran out."""
    try:
        return query.awaitTermination(seconds) is not False
    except StreamingQueryException as ended:
        if Stopped.__name__ not in str(ended):
            raise
        return True


def start_batches(
    stream: DataFrame,
    root: str,
    split: Callable[[DataFrame], dict[str, DataFrame]],
    *,
    output_mode: str = "append",
    name: str | None = None,
    once: bool = True,
    staged: bool = True,
    counted: bool = False,
    stop_after: int = 0,
) -> StreamingQuery:
    """Write each micro-batch as the tables ``split`` makes of it.

    ``once`` stops when everything present at the start is read; otherwise the query goes on. The batch is
    written to the shared folder first, so that its source is read once for all tables and a lost executor loses
    nothing; the next batch but one takes its place. For a single table ``staged`` can be left out. ``counted`` keeps the
    records of every batch in a table of counts, committed with the batch: exact over any number of batches and restarts.
    With ``stop_after`` the query fails with ``Stopped`` before the first batch after more records than that have been
    committed, in this run and earlier ones on the root (``end`` takes this for its end); a later run with a higher number
    goes on with that batch. Nothing is read twice or left out. 0 or less reads everything.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if is_committed(spark, root, batch_id):
            return
        if stop_after > 0 and taken(spark, root) > stop_after:
            raise Stopped
        came = Observation()
        if staged:
            folder = f"{root}/{STAGED}/slot={batch_id % 2}"
            batch.observe(came, F.count(F.lit(1)).alias("records")).write.mode("overwrite").parquet(folder)
            batch = spark.read.schema(batch.schema).parquet(folder)
        write_atomically(root, batch_id, split(batch), counted, came if staged else None)

    writer = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", f"{root}/checkpoint")
        .foreachBatch(write)
    )
    if name:
        writer = writer.queryName(name)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def fan_out(*names: str) -> Callable[[DataFrame], dict[str, DataFrame]]:
    """Every record, unchanged, to each of the named tables."""
    return lambda batch: {name: batch for name in names}
