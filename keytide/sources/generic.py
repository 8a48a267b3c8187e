"""Records whose type travels with them: mixed topics, JSON payloads, routing by type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from keytide.functions.records import to_text
from keytide.schemas import RECORDS


def as_generic(log: DataFrame, schema_name: str) -> DataFrame:
    """(schema_name, key, payload): the record as text under its type's full name."""
    return log.select(
        F.lit(schema_name).alias("schema_name"),
        F.col("key").cast("string").alias("key"),
        to_text(RECORDS[schema_name]).alias("payload"),
    )


def decode(payload: Column, schema: T.StructType) -> Column:
    """Typed record from JSON text or UTF-8 bytes; malformed text is an error."""
    return F.from_json(payload.cast("string"), schema, {"mode": "FAILFAST"})


def route(mixed: DataFrame, schema_name: str) -> DataFrame:
    """Only the records of one type, typed."""
    return (
        mixed.where(F.col("schema_name") == schema_name)
        .select("key", decode(F.col("payload"), RECORDS[schema_name]).alias("_record"))
        .select("key", "_record.*")
    )


def encode_value(log: DataFrame, schema: T.StructType) -> DataFrame:
    """Key and record bytes, the JSON twin of an encoded topic."""
    others = [name for name in log.columns if name not in schema.fieldNames() and name != "key"]
    return log.select("key", F.encode(to_text(schema), "UTF-8").alias("value"), *others)


def decode_value(raw: DataFrame, schema: T.StructType) -> DataFrame:
    others = [name for name in raw.columns if name not in ("key", "value")]
    return raw.select("key", decode(F.col("value"), schema).alias("_record"), *others).select(
        "key", "_record.*", *others
    )
