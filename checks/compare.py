"""Run registered queries next to their SQL and report the rows that differ.

``python -m checks.compare [sf] [query ...]``
"""

from __future__ import annotations

import math
import sys
import tempfile
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return Counter(tuple(_plain(row[at]) for at in order) for row in rows)


def differences(found: DataFrame, connection, sql: str) -> tuple[int, list, list]:
    """Row count of the query, rows only it has, rows only the SQL has."""
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(names) != sorted(found.columns):
        raise AssertionError(f"columns differ: {sorted(found.columns)} and {sorted(names)}")
    left = _rows(found.columns, found.collect())
    right = _rows(names, expected.fetchall())
    return sum(left.values()), list((left - right).elements()), list((right - left).elements())


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("checks")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="passagemill-shared-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(arguments: list[str]) -> int:
    sf = arguments[0] if arguments else "0.01"
    sf_dir = str(Path("/root/testdata") / f"sf{sf}")
    spark = session()
    connection = connect(sf_dir)
    failed = 0
    for name in arguments[1:] or QUERIES:
        began = time.time()
        try:
            if name in ORACLES:
                count, extra, missing = differences(
                    QUERIES[name](spark, sf_dir), connection, ORACLES[name]
                )
                good = not extra and not missing
                note = "" if good else f" extra {extra[:2]} missing {missing[:2]}"
            else:
                count, good, note = QUERIES[name](spark, sf_dir).count(), True, " (rows only)"
        except Exception as failure:
            count, good, note = 0, False, f" {type(failure).__name__}: {str(failure)[:600]}"
        failed += not good
        mark = "ok  " if good else "FAIL"
        print(f"{mark} {name} {count} rows {time.time() - began:.1f}s{note[:1500]}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
