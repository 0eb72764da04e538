"""Run registered queries beside their SQL and report differences.

    python tests/check_oracle.py [data folder] [query ...]
"""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tests.compare import compare_tables, register_views  # noqa: E402
from tests.session import make_session  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    # Another zone or partitioning must not change a result.
    zone, parts = os.environ.get("CHECK_ZONE", "UTC"), os.environ.get("CHECK_PARTITIONS", "8")
    spark = make_session(**{"spark.sql.session.timeZone": zone, "spark.sql.shuffle.partitions": parts})
    con = duckdb.connect()
    register_views(con, sf_dir)
    sql = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        start = time.perf_counter()
        try:
            got = query(spark, sf_dir).toPandas()
            took = time.perf_counter() - start
            if name in sql:
                start = time.perf_counter()
                want = con.sql(sql[name]).df()
                problem = compare_tables(got, want)
                took_sql = f"{time.perf_counter() - start:6.2f}"
            else:
                problem, took_sql = ("" if len(got) else "no rows"), "  rows"
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problem, took, took_sql, got = f"{type(error).__name__}: {str(error)[:1500]}", -1.0, "", []
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:32s} {len(got):7d} rows {took:6.2f}s sql {took_sql} {problem}", flush=True)
    print(f"{bad} failing")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
