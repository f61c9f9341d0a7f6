"""Run registered queries and their SQL side by side: python -m checks.compare [name …]"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES


# Intermediate tables of a run; removed when it ends.
SHARED = tempfile.TemporaryDirectory(prefix="larder-checks-")


def local_session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("larder-checks")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", SHARED.name)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_connection(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def normal(value):
    """Comparable form; keeps integers, floats and booleans apart."""
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, value)
    if isinstance(value, int):
        return (2, value)
    if isinstance(value, float):
        return (0, "") if math.isnan(value) else (3, value)
    return (4, str(value))


def as_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def difference(result: DataFrame, connection, sql: str) -> str | None:
    """None if equal, else what differs."""
    wanted = connection.execute(sql)
    names = [d[0] for d in wanted.description]
    expected = as_rows(names, wanted.fetchall())
    actual = as_rows(result.columns, result.collect())
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} instead of {sorted(names)}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows instead of {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} rows differ, first: {wrong[0]}" if wrong else None


def main() -> int:
    folder = os.environ.get("CHECK_DIR", "/root/testdata/sf0.01")
    spark, connection = local_session(), oracle_connection(folder)
    failed = 0
    for name in sys.argv[1:] or QUERIES:
        start = time.perf_counter()
        try:
            result = QUERIES[name](spark, folder)
            if name in ORACLE_SQL:
                problem = difference(result, connection, ORACLE_SQL[name])
                note = f"{result.count()} rows" if not problem else problem
            else:
                problem, note = None, f"{result.count()} rows, no SQL"
        except Exception as error:  # report and go on with the next query
            problem = note = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        state = "FAIL" if problem else "ok"
        print(f"{state:4} {name:32} {time.perf_counter() - start:6.2f}s  {note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
