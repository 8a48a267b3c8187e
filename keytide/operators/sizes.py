"""Measured sizes, which decide what may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from keytide.settings import DEFAULT_LIMITS, Limits


def _measured(table: DataFrame) -> tuple[int, int]:
    """Rows, and their size as text."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("bigint"))
    return tuple(table.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first())


def fits_broadcast(table: DataFrame, limits: Limits = DEFAULT_LIMITS) -> bool:
    """Measure a table against the replication bound: its rows, and their size as text.

    Only as many rows as the bound allows, and one more, are looked at, so a table far beyond it costs little.
    """
    rows, used = _measured(table.limit(limits.broadcast_rows + 1))
    return rows <= limits.broadcast_rows and used <= limits.broadcast_bytes


def light(table: DataFrame, limits: Limits = DEFAULT_LIMITS) -> bool:
    """Whether a table whose rows are few anyway is small enough in bytes, too."""
    return _measured(table)[1] <= limits.broadcast_bytes
