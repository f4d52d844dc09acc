"""Compare a Spark result with DuckDB's: same columns, types and rows, in any order, no tolerance."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime

import duckdb

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLE_NAMES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _kind(dtype: str) -> str:
    names = {
        "string": "VARCHAR",
        "int": "INTEGER",
        "bigint": "BIGINT",
        "double": "DOUBLE",
        "boolean": "BOOLEAN",
        "timestamp": "TIMESTAMP",
        "timestamp_ntz": "TIMESTAMP",
    }
    return names.get(dtype, dtype)


def differences(frame, connection, sql: str) -> list[str]:
    """What differs; empty if nothing does."""
    found = []
    cursor = connection.execute(sql)
    wanted_types = {column[0]: str(column[1]) for column in cursor.description}
    wanted_rows = cursor.fetchall()
    types = {name: _kind(dtype) for name, dtype in frame.dtypes}
    if types != wanted_types:
        odd = {n: (types.get(n), wanted_types.get(n)) for n in types.keys() | wanted_types.keys()}
        found.append(f"columns: {({n: t for n, t in odd.items() if t[0] != t[1]})}")
    if types.keys() != wanted_types.keys():
        return found
    names = sorted(types)
    order = [list(wanted_types).index(name) for name in names]
    have = Counter(tuple(_plain(row[name]) for name in names) for row in frame.collect())
    want = Counter(tuple(_plain(row[i]) for i in order) for row in wanted_rows)
    if have != want:
        extra, lacking = have - want, want - have
        found.append(
            f"{extra.total()} of {have.total()} rows differ ({want.total()} wanted), {names}: "
            f"have {sorted(extra, key=repr)[:3]}, want {sorted(lacking, key=repr)[:3]}"
        )
    return found
