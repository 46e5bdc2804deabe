"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

    python tests/oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("\0" if r[i] is None else str(_plain(r[i])) for i in order) for r in rows)


def compare(spark, con, query, folder: str) -> str:
    """'' when both sides agree, else what differs."""
    result = query(spark, folder)
    columns = result.columns
    rows = [tuple(r) for r in result.collect()]
    if query.sql is None:
        return "" if rows else "no rows"
    answer = con.execute(query.sql)
    sql_columns = [d[0] for d in answer.description]
    sql_rows = answer.fetchall()
    if sorted(columns) != sorted(sql_columns):
        return f"columns {sorted(columns)} != {sorted(sql_columns)}"
    ours, theirs = _rows(columns, rows), _rows(sql_columns, sql_rows)
    if ours == theirs:
        return "" if rows else "agree, but no rows"
    a, b = set(ours), set(theirs)
    return (
        f"rows {len(ours)} vs {len(theirs)}, {sorted(columns)}\n   only spark {len(a - b)}: "
        f"{sorted(a - b)[:3]}\n   only sql   {len(b - a)}: {sorted(b - a)[:3]}"
    )


def main() -> int:
    from daybook.plans import registered
    from daybook.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = local_session("oracle")
    con = connect(args.sf)
    failed = 0
    for name, query in registered().items():
        if args.names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in args.names):
            continue
        begin = time.time()
        try:
            message = compare(spark, con, query, args.sf)
        except Exception as error:  # report and go on with the next query
            message = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(message)
        kind = "sql" if query.sql else "rows"
        print(f"{'FAIL' if message else 'ok  '} {name} [{kind}] {time.time() - begin:.1f}s {message}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
