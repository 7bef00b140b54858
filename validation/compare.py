"""Run the registered queries and their SQL on one folder of tables and compare the values.

    python -m validation.compare [folder] [query ...]
"""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from validation.oracle import all_oracle_sql
from validation.queries import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def normalised(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns by name, rows in sorted order, values as text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(spark: SparkSession, connection, folder: str, name: str) -> str | None:
    frame = all_queries()[name](spark, folder)
    actual = normalised(frame.columns, frame.collect())
    result = connection.execute(all_oracle_sql()[name])
    columns = [column[0] for column in result.description]
    expected = normalised(columns, result.fetchall())
    if actual[0] != expected[0]:
        return f"columns {actual[0]} != {expected[0]}"
    if len(actual[1]) != len(expected[1]):
        return f"{len(actual[1])} rows != {len(expected[1])}"
    wrong = [(a, e) for a, e in zip(*(actual[1], expected[1]), strict=True) if a != e]
    if wrong:
        return f"{len(wrong)} of {len(actual[1])} rows differ, first {wrong[0]}"
    return None


def main() -> int:
    from lodgestar.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(all_queries())
    spark = build_session(
        "compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = differences(spark, connection, folder, name)
        except Exception as error:  # report every query, not only the first that fails
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name}: {problem or 'ok'} ({time.time() - start:.1f}s)", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
