"""Timestamp text and epoch numbers. The session zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the timestamp text of every record.
TEXT_FORMAT = "yyyy/MM/dd HH:mm:ss xxx"


def to_text(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp"), TEXT_FORMAT)


def from_text(text: Column) -> Column:
    """The instant a text names, in any offset; null where it is malformed."""
    return F.try_to_timestamp(text, F.lit(TEXT_FORMAT))


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def from_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)
