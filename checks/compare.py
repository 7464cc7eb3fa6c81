"""Run every registered query against its SQL.

    python -m checks.compare [tables folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from datetime import date, datetime
from pathlib import Path

import duckdb

from checks.oracle import ORACLE
from checks.queries import QUERIES
from shelfweek.session import build_session


def plain(value):
    if isinstance(value, float):
        return value + 0.0
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return value


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def compare(spark, con, folder: str, name: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, folder)
    rows = df.collect()
    if name not in ORACLE:
        return bool(rows), f"{len(rows)} rows, no SQL"
    found = con.execute(ORACLE[name])
    columns = [c[0] for c in found.description]
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(columns)}"
    ours, theirs = sorted_rows(df.columns, rows), sorted_rows(columns, found.fetchall())
    if len(ours) != len(theirs):
        return False, f"{len(ours)} rows against {len(theirs)}"
    apart = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if apart:
        return False, f"{len(apart)} of {len(ours)} rows differ, first {apart[0]}"
    return True, f"{len(ours)} rows equal"


def main(folder: str, names: list[str]) -> int:
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(folder), 0
    for name in names or QUERIES:
        start = time.time()
        good, note = compare(spark, con, folder, name)
        bad += not good
        print(f"{'ok  ' if good else 'FAIL'} {name:32s} {time.time() - start:6.1f}s {note}", flush=True)
    return bad


if __name__ == "__main__":
    args = sys.argv[1:]
    sys.exit(main(args[0] if args else "/root/testdata/sf0.01", args[1:]))
