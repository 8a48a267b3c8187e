"""Where intermediate tables go, and the sizes at which a plan changes shape."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, types as T

_local_folders: dict[str, str] = {}
_scratch: list[list[str]] = []


@dataclass(frozen=True)
class Limits:
    """Thresholds of the plan choices; tests lower them to reach every branch.

    broadcast_rows / broadcast_bytes: the most a replicated table may hold.
    hot_rows: a key with more rows than this is split over several tasks.
    hot_keys: the most keys to treat so; beyond, only the largest are.
    segment_rows / segments: rows per piece of a split key, and the most pieces.
    salt_rows: rows per piece a hot join key is spread over.
    versions_per_key: most table versions per key for the interval form of the as-of join.
    """

    broadcast_rows: int = 500_000
    broadcast_bytes: int = 64 << 20
    hot_rows: int = 2_000_000
    hot_keys: int = 100_000
    segment_rows: int = 1_000_000
    segments: int = 100_000
    salt_rows: int = 1_000_000
    versions_per_key: int = 32


DEFAULT_LIMITS = Limits()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="keytide-")
    return _local_folders[application]


def new_folder(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A fresh path under the shared folder; what is written there goes with the ``scratch`` block it was asked for in,
    unless it is ``lasting``."""
    folder = f"{shared_folder(spark)}/keytide/{name}-{uuid.uuid4().hex}"
    if _scratch and not lasting:
        _scratch[-1].append(folder)
    return folder


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables written inside once the block ends.

    Results are lazy, so they have to be written or read inside. Blocks nest; without one, tables stay under the
    shared folder until that is cleaned.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for folder in _scratch.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts lineage on shared storage: several consumers read columnar files instead of
    recomputing the plan, and a lost executor costs one task, not the whole chain.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(_nullable(df.schema)).parquet(path)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamp text is written and read in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
