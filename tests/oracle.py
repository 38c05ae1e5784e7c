"""Run a query and its SQL side by side."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if hasattr(value, "item"):
        return _plain(value.item())
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=repr)


def duck_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    rows = cursor.fetchall()
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def kinds(con, sql):
    return {r[0]: r[1] for r in con.execute(f"describe {sql}").fetchall()}


_FAMILY = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "float": "FLOAT",
}


def type_differences(df, con, sql):
    other = kinds(con, sql)
    mine = {f.name: _FAMILY.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    return {c: (mine[c], other.get(c)) for c in mine if mine[c] != other.get(c)}


def differences(mine, theirs, limit=5):
    if len(mine) != len(theirs):
        return [f"{len(mine)} rows against {len(theirs)}"]
    found = []
    for a, b in zip(mine, theirs, strict=True):
        if a != b:
            found.append(f"{a} | {b}")
            if len(found) >= limit:
                break
    return found
