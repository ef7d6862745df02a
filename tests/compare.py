"""Row-by-row comparison of every query with its SQL twin in DuckDB.

Run as a script for a table of results: ``python tests/compare.py [folder] [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, float):
        return ("null",) if math.isnan(value) else ("n", float(f"{value:.12g}") + 0.0)
    if isinstance(value, int):
        return ("n", float(value))
    return (type(value).__name__, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, name, fn, sql, folder):
    """None when both sides agree, else a short description of the difference."""
    df = fn(spark, folder)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}", len(got)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} rows differ, first {bad[0]}", len(got)
    return None, len(got)


def main():
    from __spark_entry__ import oracle_sql, queries
    from claimweft.session import local_session

    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    spark = local_session("8")
    con = duck(folder)
    oracle = oracle_sql()
    failed = 0
    for name, fn in queries().items():
        if args[1:] and name not in args[1:]:
            continue
        start = time.time()
        try:
            if name in oracle:
                diff, n = compare(spark, con, name, fn, oracle[name], folder)
            else:
                diff, n = None, fn(spark, folder).count()
        except Exception as exc:  # noqa: BLE001 - report and go on
            diff, n = f"{type(exc).__name__}: {str(exc)[:600]}", -1
        failed += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {name:28s} {n:8d} rows {time.time() - start:6.2f}s {diff or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
