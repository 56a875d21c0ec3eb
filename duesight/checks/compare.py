"""Run registered queries against their SQL: ``python -m duesight.checks.compare FOLDER [NAME ...]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from duesight.checks.queries import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    if isinstance(value, float):
        return f"{value:.4f}"
    return str(value)


def _rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    return sorted(tuple(_cell(row[index]) for index in order) for row in rows)


def differences(frame: DataFrame, connection, name: str) -> tuple[str, int]:
    """Empty text if the query's result and its SQL agree, else what differs; and the row count."""
    query = REGISTRY[name]
    actual = _rows(frame.columns, frame.collect())
    if query.sql is None:
        return "", len(actual)
    result = connection.execute(query.sql)
    names = [column[0] for column in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}", len(actual)
    if actual != expected:
        ours, theirs = set(actual), set(expected)
        return (
            f"rows {len(actual)} != {len(expected)}; only Spark {sorted(ours - theirs)[:2]};"
            f" only SQL {sorted(theirs - ours)[:2]}",
            len(actual),
        )
    return "", len(actual)


def main() -> int:
    folder, names = sys.argv[1], sys.argv[2:] or list(REGISTRY)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(folder), 0
    for name in names:
        started = time.time()
        try:
            text, count = differences(REGISTRY[name].run(spark, folder), connection, name)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            text, count = f"{type(error).__name__}: {str(error)[:1500]}", 0
        seconds = time.time() - started
        failed += bool(text)
        print(f"{'FAIL' if text else 'ok  '} {name:32} {count:8} rows {seconds:6.2f}s {text}", flush=True)
    print(f"{failed} of {len(names)} differ")
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
