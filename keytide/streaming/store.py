"""Rows by key in hash buckets, added to batch by batch.

A batch writes only what it brings: a file per bucket it touches. The manifest, which goes with the batch's commit, lists for
every bucket the batches whose rows it holds. A bucket with more than ``PIECES`` pieces is written anew as one, reduced to
what still counts; buckets a batch does not touch are neither read nor written. What a manifest leaves out is deleted
when the next batch is committed, so a batch can be replayed from the manifest it began with.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from keytide.sinks import commits

PIECES = 8
AT = "_at_batch"
_BUCKET = "_bucket"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Store:
    """A store under ``folder`` as a manifest describes it. A new one has as many buckets as a shuffle has partitions, unless
    its query says otherwise; a bucket should be a task's work."""

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        schema: T.StructType,
        key: str,
        manifest: dict | None,
        buckets: int | None = None,
    ):
        self.spark, self.folder, self.schema, self.key = spark, folder, schema, key
        told = manifest or {"buckets": buckets or shuffle_partitions(spark), "pieces": {}, "gone": []}
        self.buckets, self.pieces, self.gone = told["buckets"], told["pieces"], told["gone"]

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the rows' keys."""
        return sorted(rows.agg(F.collect_set(self.bucket(F.col(self.key)))).first()[0])

    def read(self, buckets: Sequence[int]) -> DataFrame:
        """All rows of the buckets, ``AT`` telling the batch that wrote them."""
        paths = [self._path(batch, b) for b in buckets for batch in self.pieces.get(str(b), [])]
        schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in self.schema], T.StructField(AT, T.LongType())])
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _path(self, batch: int, bucket: int) -> str:
        return f"{self.folder}/{batch}/{_BUCKET}={bucket}"

    def add(self, rows: DataFrame, batch: int, touched: Sequence[int], reduce: Callable[[DataFrame], DataFrame]) -> dict:
        """Write ``rows``, whose keys lie in the buckets ``touched``; returns the manifest to commit.

        ``reduce`` makes of all rows of a bucket (with ``AT``) those that still count.
        """
        full = [b for b in touched if len(self.pieces.get(str(b), [])) >= PIECES]
        new = rows.select(*self.schema.fieldNames()).withColumn(AT, F.lit(batch).cast("bigint"))
        if full:
            whole = self.bucket(F.col(self.key)).isin(full)
            kept = reduce(self.read(full).unionByName(new.where(whole)))
            new = new.where(~whole).unionByName(kept.select(*new.columns))
        (
            new.withColumn(_BUCKET, self.bucket(F.col(self.key)))
            .repartition(F.col(_BUCKET))
            .write.partitionBy(_BUCKET)
            .mode("overwrite")
            .parquet(f"{self.folder}/{batch}")
        )
        written = {int(name.split("=")[1]) for name in commits.names(self.spark, f"{self.folder}/{batch}") if "=" in name}
        pieces = {b: list(held) for b, held in self.pieces.items()}
        gone = [self._path(old, b) for b in full for old in self.pieces[str(b)]]
        for b in full:
            pieces[str(b)] = []
        for b in written:
            pieces.setdefault(str(b), []).append(batch)
        return {"buckets": self.buckets, "pieces": pieces, "gone": gone}

    def clean(self) -> None:
        """Delete what the manifest this store was read from had replaced."""
        for path in self.gone:
            commits.delete(self.spark, path)
