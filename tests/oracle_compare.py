"""Compare a Spark result with its DuckDB statement: names, types, rows as a multiset."""

from __future__ import annotations

import collections
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Spark type name to the DuckDB type that must stand on the other side.
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE",
         "boolean": "BOOLEAN", "double": "DOUBLE"}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(rows, order):
    return collections.Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql) -> list[str]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {r[0]: str(r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    expected = con.execute(sql).fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} / {sorted(names)}"]
    found = []
    for name, kind in df.dtypes:
        wanted = TYPES.get(kind, kind.upper())
        if wanted != types[name]:
            found.append(f"{name}: {kind} / {types[name]}")
    got = df.collect()
    if len(got) != len(expected):
        found.append(f"rows {len(got)} / {len(expected)}")
    columns = sorted(names)
    a = _rows(got, [df.columns.index(c) for c in columns])
    b = _rows(expected, [names.index(c) for c in columns])
    if a != b:
        only_a, only_b = list((a - b))[:2], list((b - a))[:2]
        found.append(f"values {columns}: spark {only_a} duckdb {only_b}")
    return found
