"""Run registered queries against DuckDB and compare whole results.

    python -m checks.compare [--sf-dir DIR] [NAME ...]
"""

from __future__ import annotations

import argparse
import datetime
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES
from scholaudit.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if value is None or value != value:
        return None
    if isinstance(value, datetime.datetime):
        return value.date() if value.time() == datetime.time() else value
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return sorted((tuple(_plain(row[place]) for place in order) for row in rows), key=repr)


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _rows(df.columns, df.collect())


def duckdb_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    columns = [column[0] for column in result.description]
    return sorted(columns), _rows(columns, result.fetchall())


def differences(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """What differs first, or None."""
    own_columns, own = spark_rows(QUERIES[name](spark, sf_dir))
    columns, expected = duckdb_rows(connection, ORACLE_SQL[name])
    if own_columns != columns:
        return f"columns {set(own_columns) ^ set(columns)}"
    if len(own) != len(expected):
        return f"{len(own)} rows, expected {len(expected)}"
    for mine, theirs in zip(own, expected, strict=True):
        if mine != theirs:
            found = [
                (column, str(a)[:200], str(b)[:200])
                for column, a, b in zip(columns, mine, theirs, strict=True)
                if a != b
            ]
            return f"first differing row: {found}"
    return None


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    options = parser.parse_args()
    spark = build_session(
        "compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(options.sf_dir)
    failed = 0
    for name in options.names or QUERIES:
        start = time.time()
        problem = differences(spark, connection, options.sf_dir, name)
        failed += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s  {problem or 'ok'}", flush=True)
    print(f"{failed} differ")


if __name__ == "__main__":
    main()
