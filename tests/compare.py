"""Run a registered job and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    if isinstance(value, float):
        return repr(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def differences(df, con, sql) -> list[str]:
    """What differs between the rows (and column types) of ``df`` and of ``sql``; [] if nothing."""
    found = []
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = _rows(names, result.fetchall())
    spark_kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for name, kind in spark_kinds.items():
        if _KINDS.get(kind) != kinds[name]:
            found.append(f"{name}: {kind} against {kinds[name]}")
    actual = _rows(df.columns, df.collect())
    if actual != expected:
        found.append(f"{sum(actual.values())} rows against {sum(expected.values())}")
        found.append(f"only spark: {list((actual - expected).items())[:3]}")
        found.append(f"only sql: {list((expected - actual).items())[:3]}")
    return found
