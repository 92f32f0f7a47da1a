"""Run Spark queries next to their DuckDB oracle text and compare results.

Comparison: same column-name set, same row count, and equal multisets of
rows after normalising values (columns sorted by name).  Usable from pytest
and as a script: ``python tests/oracle_compare.py [sf_dir] [key ...]``.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
from collections import Counter

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (bool, int, str)):
        return repr(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in records)


def compare(spark, sf_dir: str, key: str, fn, sql: str | None, con=None) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return True, f"{len(s_rows)} rows (no oracle)"
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duck={len(d_rows)}"
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    if a != b:
        only_s = list((a - b).elements())[:3]
        only_d = list((b - a).elements())[:3]
        return False, f"values differ ({sum((a - b).values())} rows); cols={sorted(s_cols)}\n  spark-only={only_s}\n  duck-only={only_d}"
    return True, f"{len(s_rows)} rows match"


def main(argv):
    import time

    from pyspark.sql import SparkSession

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    import __spark_entry__ as entry

    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or list(qs):
        t = time.time()
        try:
            ok, msg = compare(spark, sf_dir, k, qs[k], sqls.get(k), con)
        except Exception as e:  # report and go on
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:800]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {k:34s} {time.time() - t:6.2f}s {msg}", flush=True)
    print(f"{len(keys or qs) - bad} ok, {bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
