"""Runs registered queries and their SQL over the test tables and compares the results."""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time

import duckdb

from catalog import QUERIES, SQL
from ledgerspark.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.6g}" if abs(value) < 1e-3 else f"{value:.4f}"
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    return value


def rows_of(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(plain(r[i])) for i in at) for r in rows)


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    args = parser.parse_args()
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{args.sf}/{t}.parquet'")
    bad = 0
    for name in args.names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, args.sf)
            got = rows_of(df.columns, df.collect())
        except Exception as problem:  # noqa: BLE001 - report and go on
            bad += 1
            print(f"FAIL {name}: {str(problem)[:1500]}", flush=True)
            continue
        took = time.time() - start
        if name not in SQL:
            print(f"rows {name}: {len(got)} rows, {took:.2f}s", flush=True)
            continue
        try:
            cur = db.execute(SQL[name])
            names = [c[0] for c in cur.description]
            want = rows_of(names, cur.fetchall())
        except Exception as problem:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name} (sql): {str(problem)[:800]}", flush=True)
            continue
        same = got == want and sorted(names) == sorted(df.columns)
        bad += not same
        print(f"{'ok  ' if same else 'DIFF'} {name}: {len(got)} rows, {took:.2f}s", flush=True)
        if not same:
            print("  columns", sorted(df.columns), sorted(names) if sorted(names) != sorted(df.columns) else "")
            print("  counts", len(got), len(want))
            a, b = set(got), set(want)
            print("  spark only", list(a - b)[:3])
            print("  sql only  ", list(b - a)[:3])
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
