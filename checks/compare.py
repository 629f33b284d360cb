"""Runs every query and its oracle and compares rows without regard to order."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES
from checks.standins import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_by_name(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def difference(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> str:
    """Empty if query and oracle agree, else what differs."""
    df = QUERIES[name](spark, sf_dir)
    got = rows_by_name(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(ORACLES[name])
    want_columns = [d[0] for d in result.description]
    want = rows_by_name(want_columns, result.fetchall())
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} against {sorted(want_columns)}"
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{sum(got.values())} rows against {sum(want.values())}: {extra} not {missing}"
    return "" if want else "no rows"


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            problem = difference(spark, con, name, sf_dir)
        except Exception as error:  # noqa: BLE001 - report it and go on
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem[:2500]}")
    return failed


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    sys.exit(main(sys.argv[1], sys.argv[2:]))
