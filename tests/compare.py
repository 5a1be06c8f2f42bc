"""Row-for-row comparison of a Spark query with its SQL twin in DuckDB."""

from __future__ import annotations

import datetime
import decimal
import glob
import os

import duckdb

KINDS = {
    "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "bigint", "HUGEINT": "hugeint",
    "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def differences(df, sql: str, connection) -> list[str]:
    """What differs between the two results; empty when they agree."""
    relation = connection.sql(sql)
    ours, theirs = dict(df.dtypes), dict(zip(relation.columns, map(str, relation.types)))
    found = []
    if set(ours) != set(theirs):
        return [f"columns {sorted(ours)} against {sorted(theirs)}"]
    for name, kind in ours.items():
        if KINDS.get(theirs[name], theirs[name]) != kind:
            found.append(f"type of {name}: {kind} against {theirs[name]}")
    names = sorted(ours)
    places = [relation.columns.index(name) for name in names]
    left = sorted((tuple(plain(row[name]) for name in names) for row in df.collect()), key=repr)
    right = sorted((tuple(plain(row[place]) for place in places) for row in relation.fetchall()), key=repr)
    if len(left) != len(right):
        found.append(f"{len(left)} rows against {len(right)}")
    if left != right:
        only_left, only_right = set(left) - set(right), set(right) - set(left)
        found.append(f"{len(only_left)} rows differ, such as")
        found += [f"  ours   {row}" for row in sorted(only_left, key=repr)[:3]]
        found += [f"  theirs {row}" for row in sorted(only_right, key=repr)[:3]]
    return found
