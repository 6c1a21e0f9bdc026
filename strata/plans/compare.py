"""Runs a registered query next to its SQL oracle and compares the two results."""

from __future__ import annotations

import math
import os
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        if math.isnan(value):
            return (2, "nan")
        return (2, repr(value + 0.0))
    if isinstance(value, int):
        return (2, repr(float(value))) if abs(value) < 2**53 else (2, str(value))
    if hasattr(value, "isoformat"):
        return (3, value.isoformat())
    if hasattr(value, "as_tuple"):
        return (2, repr(float(value)))
    return (4, str(value))


def table_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    body = sorted(tuple(normal(row[i]) for i in order) for row in rows)
    return [names[i] for i in order], body


def differences(spark, name, query, sql, sf_dir, connection):
    """Empty list when both results agree; the number of rows and the time come along."""
    started = time.time()
    result = query(spark, sf_dir)
    rows = [tuple(r) for r in result.collect()]
    seconds = time.time() - started
    if sql is None:
        return [], len(rows), seconds
    found = connection.execute(sql)
    oracle_names = [c[0] for c in found.description]
    spark_names, spark_rows = table_of(result.columns, rows)
    oracle_names, oracle_rows = table_of(oracle_names, found.fetchall())
    problems = []
    if spark_names != oracle_names:
        problems.append(f"columns {spark_names} <> {oracle_names}")
    elif len(spark_rows) != len(oracle_rows):
        problems.append(f"rows {len(spark_rows)} <> {len(oracle_rows)}")
    else:
        unequal = [(a, b) for a, b in zip(spark_rows, oracle_rows) if a != b]
        if unequal:
            problems.append(f"{len(unequal)} rows differ, first {unequal[0]}")
    return problems, len(spark_rows), seconds
