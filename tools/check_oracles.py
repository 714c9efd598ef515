"""Run registered queries on Spark and their oracles on DuckDB and compare the rows.

python tools/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tallyline.catalog import oracles, queries  # noqa: E402
from tallyline.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        value = float(value)
        if math.isfinite(value) and value == int(value):
            return str(int(value))
        return f"{value:.9g}"
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str, df=None) -> tuple[str, int, float]:
    """Verdict, number of rows and seconds of one query; ``df`` if it is already built."""
    start = time.time()
    df = queries()[name](spark, sf_dir) if df is None else df
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if name not in oracles():
        return "rows only", len(got), took
    cur = con.execute(oracles()[name])
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}", len(got), took
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        only_a, only_b = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        return f"ROWS DIFFER {len(a)} vs {len(b)}\n   {sorted(names)}\n   spark {only_a}\n   duck  {only_b}", len(got), took
    return "ok" if got else "ok BUT EMPTY", len(got), took


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con = local_session("check"), connect(sf_dir)
    bad = 0
    for name in args or queries():
        try:
            verdict, n, took = compare(spark, con, name, sf_dir)
        except Exception as e:  # report and go on to the next query
            verdict, n, took = f"ERROR {type(e).__name__}: {str(e)[:600]}", -1, 0.0
        bad += not verdict.startswith(("ok", "rows only"))
        if verdict != "ok" or args:
            print(f"{name}: {verdict}", flush=True)
        print(f"  {name:32s} rows={n} {took:.2f}s", flush=True)
    print(f"{len(args or queries())} queries, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(main())
