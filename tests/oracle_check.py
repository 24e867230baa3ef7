"""Run bound queries on Spark and their SQL on DuckDB and compare all values.

    python tests/oracle_check.py [sf directory] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def differences(spark_df, connection, sql: str) -> str | None:
    """None if rows and columns agree, else what differs."""
    relation = connection.execute(sql)
    sql_columns = [d[0] for d in relation.description]
    columns = sorted(spark_df.columns)
    if sorted(sql_columns) != columns:
        return f"columns {columns} != {sorted(sql_columns)}"
    places = [sql_columns.index(c) for c in columns]
    expected = sorted((tuple(row[i] for i in places) for row in relation.fetchall()), key=_sort_key)
    actual = sorted((tuple(row) for row in spark_df.select(*columns).collect()), key=_sort_key)
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected, strict=True) if not _same_row(a, e)]
    return f"{len(wrong)} of {len(actual)} rows differ, first: {wrong[0]}" if wrong else None


def _sort_key(row):
    return tuple((v is None, str(type(v) is str), round(v, 4) if isinstance(v, float) else v) if v is not None
                 else (True, "", 0) for v in row)


def _same_row(a, b):
    return all(_same(x, y) for x, y in zip(a, b, strict=True))


def _same(x, y):
    """Same type and value; floats to the last digit, since value hashes compare them so."""
    return type(x) is type(y) and (x == y or (isinstance(x, float) and math.isnan(x) and math.isnan(y)))


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    failures = 0
    oracles = entry.oracle_sql()
    for name, build in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        started = time.time()
        try:
            df = build(spark, sf_dir)
            result = differences(df, connection, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        failures += result is not None
        print(f"{name:32} {time.time() - started:6.2f}s  {result or 'ok'}", flush=True)
    print(f"{failures} failures")
    return failures


if __name__ == "__main__":
    sys.exit(main())
