"""The region lookup table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Code, name and dialling prefix of each region, by index.
# "UK" carries the prefix of "DE", so nothing may join on the prefix.
REGIONS = (
    ("UK", "United Kingdom", "+49"),
    ("DE", "Germany", "+49"),
    ("FR", "France", "+33"),
    ("IT", "Italy", "+39"),
    ("UA", "Ukraine", "+380"),
    ("SE", "Sweden", "+46"),
    ("DK", "Denmark", "+45"),
    ("NO", "Norway", "+47"),
    ("PL", "Poland", "+48"),
    ("IS", "Iceland", "+354"),
    ("US", "United States of America", "+1"),
    ("IE", "Ireland", "+353"),
    ("IN", "India", "+91"),
    ("HK", "Hong Kong", "+852"),
)


def region_table(spark: SparkSession) -> DataFrame:
    """identifier, longName, areaCode: one row per region."""
    rows = ", ".join(f"('{code}', '{name}', '{prefix}')" for code, name, prefix in REGIONS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS regions(identifier, longName, areaCode)")


def region_field(index: Column, field: int) -> Column:
    """A field (0 code, 1 name, 2 prefix) of region ``index`` modulo their number."""
    values = F.array(*[F.lit(region[field]) for region in REGIONS])
    return F.get(values, F.pmod(index, F.lit(len(REGIONS))).cast("int"))
