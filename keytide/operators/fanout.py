"""Records that become several records: delete markers behind inserts, parent and children."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from keytide.functions import uniform

# Distance of deletes behind inserts, most children per parent, child text.
COUNTER_GAP = 1000
MAX_FILES = 10
FILE_PREFIX = "//depot/project/file"
FILE_REVISION = 1
FILE_ACTION = "add"


def counter_log(steps: DataFrame, offset: int, gap: int | None = COUNTER_GAP) -> DataFrame:
    """Inserts of rising ids, and a delete of the oldest live id after each step beyond ``gap``.

    Without a gap nothing is deleted.

    ``steps`` has ``n`` = 0, 1, 2, … and ``timestamp``. Step n inserts ``offset + n + 1``; the
    id that step deletes follows from n alone, so no state is needed. ``off`` is the place in
    the log; at most 1 delete follows each insert.
    """
    inserted = F.struct(
        (F.lit(offset) + F.col("n") + 1).alias("key"),
        F.col("timestamp").alias("timestamp"),
        F.lit(False).alias("is_deleted"),
        (F.col("n") * 2).alias("off"),
    )
    if gap is None:
        return steps.select(inserted.alias("_r")).select("_r.*")
    removed = F.struct(
        (F.lit(offset) + F.col("n") - gap).alias("key"),
        F.lit(None).cast("bigint").alias("timestamp"),
        F.lit(True).alias("is_deleted"),
        (F.col("n") * 2 + 1).alias("off"),
    )
    written = F.when(F.col("n") > gap, F.array(inserted, removed)).otherwise(F.array(inserted))
    return steps.select(F.explode(written).alias("_r")).select("_r.*")


def as_payload(log: DataFrame) -> DataFrame:
    """The counter log as topics take it: key, and the record as JSON or null for a delete."""
    record = F.to_json(F.struct(F.col("key").alias("counterId"), "timestamp"))
    return log.select("key", F.when(~F.col("is_deleted"), record).alias("value"), "off")


def revisions(changes: DataFrame, seed: int, max_files: int = MAX_FILES) -> DataFrame:
    """1 to ``max_files`` child records per change."""
    files = uniform.below(seed, "files", F.col("change"), max_files)
    return changes.select(
        "change", F.explode(F.sequence(F.lit(0), files)).alias("_file")
    ).select(
        "change",
        F.concat(F.lit(FILE_PREFIX), F.col("_file").cast("string")).alias("filename"),
        F.lit(FILE_REVISION).alias("revision"),
        F.lit(FILE_ACTION).alias("action"),
    )
