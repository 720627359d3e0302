"""Compare a Spark result with the result of SQL on the same Parquet files, regardless of row order."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES.split():
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, dt.date):
        return value.isoformat()
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    got_types = {name: TYPES[kind] for name, kind in df.dtypes}
    types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    if got_types != types:
        return f"types {sorted(got_types.items())} instead of {sorted(types.items())}"
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    expected = rows_of(names, result.fetchall())
    got = rows_of(df.columns, [tuple(row) for row in df.collect()])
    if got == expected:
        return None
    only_got, only_expected = [r for r in got if r not in set(expected)], [r for r in expected if r not in set(got)]
    return f"{len(got)} rows instead of {len(expected)}; unexpected {only_got[:3]}, missing {only_expected[:3]}"
