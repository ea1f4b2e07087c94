"""Run a registered query and its checking SQL, and compare the rows whatever their order."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

from tallyforge.catalog.registry import TABLES


def open_tables(folder: str):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_plain(v) for v in value) + "]"
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


_KINDS = {
    "bigint": "int64", "long": "int64", "int": "int32", "integer": "int32", "double": "double", "string": "varchar",
    "boolean": "boolean", "hugeint": "hugeint", "varchar": "varchar",
}


def compare(spark, folder: str, query, oracle: str):
    """None if equal, else a message."""
    df = query(spark, folder)
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    connection = open_tables(folder)
    result = connection.execute(oracle)
    columns = [d[0] for d in result.description]
    wanted = rows_of(columns, result.fetchall())
    spark_kinds = {n: _KINDS.get(t, t) for n, t in df.dtypes}
    duck_kinds = {d[0]: _KINDS.get(str(d[1]).lower(), str(d[1]).lower()) for d in result.description}
    if found[0] != wanted[0]:
        return f"columns {found[0]} but {wanted[0]}"
    odd = {n: (spark_kinds[n], duck_kinds[n]) for n in spark_kinds if spark_kinds[n] != duck_kinds[n]}
    kinds = f" kinds {odd}" if odd else ""
    if len(found[1]) != len(wanted[1]):
        return f"{len(found[1])} rows but {len(wanted[1])}{kinds}"
    if found[1] != wanted[1]:
        bad = [(a, b) for a, b in zip(found[1], wanted[1]) if a != b]
        return f"{len(bad)} rows differ, first {bad[0]}{kinds}"
    return f"only{kinds}" if odd and any("hugeint" in v or "decimal" in str(v) for v in odd.values()) else None
