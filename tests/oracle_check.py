"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and the order-insensitive multiset of rows
(floats rounded to 6 places).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


def compare(spark, sf_dir, names=None, verbose=True):
    import __spark_entry__ as E
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = []
    for name in names or list(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        cols = df.columns
        got = rows_of(cols, [tuple(r) for r in df.collect()])
        t1 = time.time()
        if name not in orc:
            if verbose:
                print(f"{name:32s} rows={len(got):7d} (no oracle) {t1 - t0:.1f}s")
            continue
        res = con.execute(orc[name])
        ocols = [d[0] for d in res.description]
        exp = rows_of(ocols, res.fetchall())
        ok = sorted(cols) == sorted(ocols) and got == exp
        if verbose:
            print(f"{name:32s} rows={len(got):7d} oracle={len(exp):7d} {'OK' if ok else 'MISMATCH'} {t1 - t0:.1f}s")
        if not ok:
            bad.append(name)
            if sorted(cols) != sorted(ocols):
                print("   columns", sorted(cols), sorted(ocols))
            else:
                gs, es = set(got), set(exp)
                print("   spark-only", list(gs - es)[:3])
                print("   oracle-only", list(es - gs)[:3])
    return bad


if __name__ == "__main__":
    from lociframe.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8)
    bad = compare(spark, sf, sys.argv[2:] or None)
    print("FAILED:", bad if bad else "none")
