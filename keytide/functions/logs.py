"""Small helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Arrival order decides "newest" and "first"; it is unique within a log.
ARRIVAL = ("off",)


def position(order: Sequence[str]) -> Column:
    """One comparable value for a list of order columns.

    A single fixed-width column stays bare: aggregates over it then run as hash aggregates,
    which a struct rules out.
    """
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)
