"""Comparison of a Spark result with its check query."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, decimal.Decimal):
        raise AssertionError("decimals leave a query only as doubles")
    return value


def _family(value) -> str:
    return "none" if value is None else type(value).__name__


def difference(spark_frame, connection, sql: str) -> str | None:
    """None if both give the same columns and the same rows, in any order."""
    relation = connection.sql(sql)
    names, expected_names = sorted(spark_frame.columns), sorted(relation.columns)
    if names != expected_names:
        return f"columns differ: {sorted(set(names) ^ set(expected_names))}"
    order = [relation.columns.index(n) for n in names]
    expected = Counter(tuple(_plain(row[i]) for i in order) for row in relation.fetchall())
    actual = Counter(tuple(_plain(v) for v in row) for row in spark_frame.select(*names).collect())
    if actual == expected:
        first, other = next(iter(actual), ()), next(iter(expected), ())
        kinds = [{_family(a), _family(b)} - {"none"} for a, b in zip(first, other)]
        mixed = [n for n, kind in zip(names, kinds) if len(kind) > 1]
        return f"types differ: {mixed}" if mixed else None
    only_spark, only_sql = list((actual - expected).items())[:2], list((expected - actual).items())[:2]
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; {names}\n"
        f"only Spark: {only_spark}\nonly SQL: {only_sql}"
    )
