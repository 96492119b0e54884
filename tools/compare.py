"""Run the named queries and their SQL side by side and report every difference.

    python tools/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    values = [tuple(plain(r[i]) for i in order) for r in rows]
    return names, sorted(values, key=repr)


def kinds(values):
    """The Python type of each column, as far as it has values."""
    found = []
    for column in zip(*values):
        found.append({type(v).__name__ for v in column if v is not None})
    return found


def difference(spark_side, sql_side):
    (a_names, a), (b_names, b) = spark_side, sql_side
    if a_names != b_names:
        return f"columns differ: only spark {set(a_names) - set(b_names)}, only sql {set(b_names) - set(a_names)}"
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}; first spark {a[:2]} first sql {b[:2]}"
    if a == b and kinds(a) == kinds(b):
        return None
    if a == b:
        return f"types differ: {a_names} {kinds(a)} against {kinds(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, columns {a_names}, first {bad[:2]}"


def connect(sf):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from catalog import all_queries, all_sql
    from siltstone.session import build_session

    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    builds, sql = all_queries(), all_sql()
    failed = 0
    for name in args.names or builds:
        start = time.time()
        try:
            df = builds[name](spark, args.sf)
            ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
            took = time.time() - start
            if name in sql:
                result = con.execute(sql[name])
                theirs = rows_of([c[0] for c in result.description], result.fetchall())
                problem = difference(ours, theirs)
            else:
                problem = None
            note = "" if name in sql else " (rows only)"
            state = "ok  " if problem is None else "DIFF"
            print(f"{state} {name}{note}: {len(ours[1])} rows, {took:.1f}s" + (f"\n     {problem}" if problem else ""), flush=True)
            failed += problem is not None
        except Exception as error:
            failed += 1
            print(f"FAIL {name}: {str(error)[:900]}", flush=True)
    print(f"{failed} of {len(args.names or builds)} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
