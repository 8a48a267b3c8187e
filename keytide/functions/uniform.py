"""Seeded uniform values that depend on the row alone.

``rand(seed)`` changes with the partitioning and so with a retry on another layout; a digest
of (seed, field, row number) does not.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_DIGITS = 15


def bits(seed: int, field: str, n: Column) -> Column:
    """60 uniform bits as a non-negative bigint."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{field}:"), n.cast("string")))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("bigint")


def below(seed: int, field: str, n: Column, bound: int) -> Column:
    """Uniform int in [0, bound)."""
    return F.pmod(bits(seed, field, n), F.lit(bound).cast("bigint")).cast("int")


def unit(seed: int, field: str, n: Column) -> Column:
    """Uniform double in [0, 1), a multiple of 2^-24 so that it is exact as a float too."""
    return F.pmod(bits(seed, field, n), F.lit(1 << 24).cast("bigint")).cast("double") / F.lit(float(1 << 24))
