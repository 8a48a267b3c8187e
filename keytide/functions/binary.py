"""Hex text of bytes and integers, and the 128-bit counter."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the 128-bit counter starts here.
COUNTER_START = 0x430E009A80B53D7896A57BFE4DD91954


def bytes_to_hex(value: Column) -> Column:
    """Two upper-case digits per byte."""
    return F.hex(value)


def integer_text(value: Column) -> Column:
    """Big-endian unsigned bytes as lower-case hex without leading zeros."""
    digits = F.ltrim(F.lower(F.hex(value)), F.lit("0"))
    return F.when(digits == "", F.lit("0")).otherwise(digits)


def low_int32(value: Column) -> Column:
    """The low 32 bits of big-endian bytes as a signed int."""
    low = F.conv(F.right(F.hex(value), F.lit(8)), 16, 10).cast("bigint")
    return F.shiftright(F.shiftleft(low, 32), 32).cast("int")


def counter_bytes(step: Column) -> Column:
    """The 128-bit counter ``step`` increments after its start, as 16 big-endian bytes.

    The halves are 64-bit integers. The low half starts negative as a signed number, so it has
    carried into the high half exactly when the sum is no longer negative.
    """
    high, low = COUNTER_START >> 64, COUNTER_START & (2**64 - 1)
    low_sum = F.lit(low - 2**64) + step.cast("bigint")
    high_sum = F.lit(high) + F.when(low_sum >= 0, F.lit(1)).otherwise(F.lit(0))
    digits = F.concat(*[F.lpad(F.hex(half), 16, "0") for half in (high_sum, low_sum)])
    return F.unhex(digits)
