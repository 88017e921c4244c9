"""Order-free comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import glob
import math
import os
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        if glob.glob(f"{sf_dir}/{table}.parquet"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{os.path.join(sf_dir, table)}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ", timespec="microseconds")
    if isinstance(value, date):
        return value.isoformat()
    return value


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    values = sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)
    return names, values


def spark_result(df):
    return normalised(df.columns, [tuple(row) for row in df.collect()])


def duckdb_result(connection, sql):
    cursor = connection.execute(sql)
    return normalised([column[0] for column in cursor.description], cursor.fetchall())


def difference(ours, theirs) -> str | None:
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"{len(ours[1])} rows != {len(theirs[1])} rows"
    for a, b in zip(ours[1], theirs[1], strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{dict(zip(ours[0], a))} != {dict(zip(ours[0], b))}"
    return None
