"""Runs registered queries and their SQL side by side: python tests/compare.py [sf] [name ...]"""

import math
import os
import sys
import time
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def check(spark, con, name, sf_dir):
    """(problem or None, rows, Spark seconds, SQL seconds)."""
    import __spark_entry__ as entry

    start = time.time()
    df = entry.queries()[name](spark, sf_dir)
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None, len(got[1]), took, 0.0
    start = time.time()
    rel = con.sql(sql)
    want = table_of(rel.columns, rel.fetchall())
    sql_took = time.time() - start
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}", len(got[1]), took, sql_took
    if got[1] != want[1]:
        a, b = set(map(repr, got[1])), set(map(repr, want[1]))
        return (f"{len(got[1])} rows != {len(want[1])}; only spark {sorted(a - b)[:2]}; only sql {sorted(b - a)[:2]}",
                len(got[1]), took, sql_took)
    return None, len(got[1]), took, sql_took


if __name__ == "__main__":
    from tablesift.session import local_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session("8"), connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or entry.queries():
        try:
            problem, rows, took, sql_took = check(spark, con, name, sf_dir)
        except Exception as exc:
            problem, rows, took, sql_took = f"{type(exc).__name__}: {str(exc)[:600]}", 0, 0, 0
        bad += problem is not None
        mark = "FAIL" if problem else "ok  " if name in entry.oracle_sql() else "rows"
        print(f"{mark} {name:26s} rows={rows:<7d} spark={took:6.2f}s sql={sql_took:6.2f}s {problem or ''}"[:900], flush=True)
    print("problems:", bad)
