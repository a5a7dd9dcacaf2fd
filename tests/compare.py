"""Runs a query in Spark and its SQL counterpart in DuckDB and compares schema and rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb

TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(round(value, 9)))
    if isinstance(value, (dt.datetime, dt.date)):
        return (1, value.isoformat())
    return (1, str(value))


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    df = query(spark, sf_dir)
    relation = con.sql(sql)
    ours = {f.name: TYPE_NAMES.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema.fields}
    theirs = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    problems = []
    if ours != theirs:
        odd = {n: (ours.get(n), theirs.get(n)) for n in ours.keys() | theirs.keys()
               if ours.get(n) != theirs.get(n)}
        problems.append(f"schema {odd}")
    if ours.keys() != theirs.keys():
        return problems
    names = sorted(ours)
    left = sorted(tuple(_key(row[n]) for n in names) for row in df.collect())
    at = [relation.columns.index(n) for n in names]
    right = sorted(tuple(_key(row[i]) for i in at) for row in relation.fetchall())
    if len(left) != len(right):
        problems.append(f"rows {len(left)} / {len(right)}")
    if left != right:
        extra, missing = set(left) - set(right), set(right) - set(left)
        problems.append(f"values {names} only spark {sorted(extra)[:2]} only sql {sorted(missing)[:2]}")
    elif not left:
        problems.append("empty result")
    return problems
