"""Compare a Spark result with DuckDB's on the same tables."""

from __future__ import annotations

import datetime
import decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        if Path(f"{sf_dir}/{table}.parquet").exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float):
        return repr(round(value, 9))
    return value if value is None else f"{type(value).__name__}:{value}"


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
               "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    relation = con.sql(sql)
    theirs = dict(zip(relation.columns, map(str, relation.types)))
    mine = {c: _DUCK_TYPES.get(t, t.upper()) for c, t in df.dtypes}
    found = []
    if mine != theirs:
        found.append(f"schema {sorted(set(mine.items()) ^ set(theirs.items()))}")
    a = rows_of(df.columns, [tuple(r) for r in df.collect()])
    b = rows_of(relation.columns, relation.fetchall())
    if len(a) != len(b):
        found.append(f"{len(a)} rows against {len(b)}")
    elif a != b:
        i = next(i for i, (x, y) in enumerate(zip(a, b)) if x != y)
        found.append(f"row {i}: {a[i]} against {b[i]}")
    if not a:
        found.append("empty result")
    return found
