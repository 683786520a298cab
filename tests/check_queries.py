"""Run every query, or those named, and compare it with its SQL: ``python -m tests.check_queries [name...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entries  # noqa: E402
from tests.oracle import connect, spark_rows, sql_rows  # noqa: E402

# DuckDB type of each Spark type.
SAME = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def main(names: list[str]) -> int:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, function in entries.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            columns, kinds, rows = spark_rows(function(spark, sf_dir))
            spent = time.time() - start
            sql = entries.oracle_sql().get(name)
            if sql is None:
                print(f"rows-only {name} {len(rows)} {spent:.1f}s {rows[:2]}", flush=True)
                continue
            expected = sql_rows(con, sql)
            same = columns == expected[0] and rows == expected[2]
            types = [SAME.get(k, k) for k in kinds] == expected[1]
            print(f"{'ok  ' if same and types else 'TYPE' if same else 'DIFF'} {name} {len(rows)} {spent:.1f}s", flush=True)
            if same and not types:
                print("   ", list(zip(columns, kinds, expected[1])))
            if not same:
                bad += 1
                print("   ", columns, expected[0], len(rows), len(expected[2]))
                for mine, theirs in [(a, b) for a, b in zip(rows, expected[2]) if a != b][:3]:
                    print("    spark", mine, "\n    sql  ", theirs)
        except Exception:
            bad += 1
            print(f"FAIL {name}", traceback.format_exc()[-1500:], flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
