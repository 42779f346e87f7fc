"""Runs a registered query and its SQL on the same files and compares whole results."""

import math
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, (int, float, Decimal)):
        return ("number", type(value).__name__, round(float(value), 9) + 0.0)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(one) for one in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(frame, connection, sql):
    """None if both agree in columns and rows; else a short description."""
    result = connection.execute(sql)
    names = [one[0] for one in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    found = rows_of(frame.columns, [tuple(row) for row in frame.collect()])
    if expected == found:
        return None
    only_sql = list((expected - found).items())[:3]
    only_spark = list((found - expected).items())[:3]
    return (
        f"{sum(found.values())} rows in Spark, {sum(expected.values())} in SQL; "
        f"only SQL {only_sql}; only Spark {only_spark}"
    )
