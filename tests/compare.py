"""Compare a query's rows and types with those of its SQL."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = ("part", "orders", "lineitem", "events")
# How DuckDB names the types Spark returns.
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "float": "FLOAT",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def database(folder: str, tables=TABLES) -> duckdb.DuckDBPyConnection:
    base = duckdb.connect()
    base.execute("SET TimeZone = 'UTC'")
    for name in tables:
        path = Path(folder) / f"{name}.parquet"
        pattern = path / "*.parquet" if path.is_dir() else path
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{pattern}'")
    return base


def arranged(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def differences(result: DataFrame, base: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in types, row count or values; empty if nothing does."""
    oracle = base.sql(sql)
    found = []
    got_types = {name: KINDS.get(kind, kind) for name, kind in result.dtypes}
    want_types = dict(zip(oracle.columns, map(str, oracle.types)))
    if got_types != want_types:
        found.append(f"types {got_types} not {want_types}")
    got, want = arranged(result.columns, result.collect()), arranged(oracle.columns, oracle.fetchall())
    if len(got) != len(want):
        found.append(f"{len(got)} rows not {len(want)}")
    unequal = [pair for pair in zip(got, want) if pair[0] != pair[1]]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return found
