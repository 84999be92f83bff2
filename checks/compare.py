"""Run every registered query against its SQL and report differences.

    python -m checks.compare [sf_dir] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

from bondscope.session import build_session
from checks.oracle import ORACLE
from checks.spark_queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    frame = QUERIES[name](spark, sf_dir)
    got_rows = frame.collect()
    if name not in ORACLE:
        return True, f"{len(got_rows)} rows, no SQL"
    result = con.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(frame.columns):
        return False, f"columns {sorted(set(names) ^ set(frame.columns))}"
    a, b = _rows(frame.columns, got_rows), _rows(names, want)
    if len(a) != len(b):
        return False, f"rows {len(a)} against {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return not wrong, f"{len(a)} rows" + (f", {len(wrong)} differ, first {wrong[0]}" if wrong else "")


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session(
        "compare",
        f"local[{os.cpu_count()}]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in argv[1:] or QUERIES:
        started = time.time()
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as error:  # show which query broke and go on
            ok, note = False, str(error)[:600]
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} ({time.time() - started:.1f}s): {note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
