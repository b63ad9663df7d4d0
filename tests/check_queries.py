"""Compare registered queries with their SQL: python tests/check_queries.py [sf] [name ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from pavilion.session import build_session  # noqa: E402
from tests.compare import compare, connect  # noqa: E402


def main() -> int:
    sf, *names = sys.argv[1:] or ["0.01"]
    folder = f"/root/testdata/sf{sf}"
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    connection, queries, oracles = connect(folder), entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            if name in oracles:
                problem, rows = compare(df, connection, oracles[name]), ""
            else:
                problem, rows = "", f" {df.count()} rows, no SQL"
        except Exception as error:
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {time.time() - start:6.2f}s{rows} {problem}", flush=True)
    print(f"{len(names or queries)} queries, {len(oracles)} with SQL, {bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
