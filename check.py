"""Run the registered queries next to their SQL and report what differs.

    python check.py [folder] [query ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
import pandas as pd

from logtide.plans.registry import QUERIES, oracle_sql
from logtide.session import build_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    if isinstance(value, float):
        return f"{value:.6f}".rstrip("0").rstrip(".").replace("-0", "0") if value == 0 else f"{value:.6f}"
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, int) or hasattr(value, "item"):
        return _cell(value.item()) if hasattr(value, "item") else str(value)
    return str(value)


def rows_of(records, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in records)


def compare(spark, con, folder: str, name: str, sql: str | None) -> tuple[bool, str]:
    df = QUERIES[name](spark, folder)
    ours = rows_of([tuple(r) for r in df.collect()], df.columns)
    if sql is None:
        return True, f"{len(ours)} rows, no SQL"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    theirs = rows_of(result.fetchall(), columns)
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(columns)}"
    if ours == theirs:
        return True, f"{len(ours)} rows"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b][:2]
    return False, f"{len(ours)} against {len(theirs)} rows, first differences {wrong}"


def main(args: list[str]) -> int:
    folder = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="8g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(folder), oracle_sql(), 0
    for name in args[1:] or QUERIES:
        start = time.time()
        try:
            ok, text = compare(spark, con, folder, name, oracle.get(name))
        except Exception as problem:  # report and go on
            ok, text = False, f"{type(problem).__name__}: {str(problem)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28} {time.time() - start:6.1f}s  {text}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
