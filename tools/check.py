"""Compare registered queries with their SQL counterparts in DuckDB.

usage: check.py [--sf 0.01] [name ...]   (names may be prefixes)
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, float):
        return v + 0.0
    return v


def rows_of(pdf):
    cols = sorted(pdf.columns)
    recs = [tuple(norm(x) for x in r) for r in pdf[cols].astype(object).where(pdf[cols].notna(), None).values.tolist()]
    return cols, sorted(recs, key=lambda r: tuple((x is not None, str(type(x)), x) if not isinstance(x, tuple) else (True, "t", str(x)) for x in r))


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()
    from orrery.plans import load_all
    from orrery.plans.registry import ORACLES, QUERIES
    from orrery.session import build_session

    load_all()
    d = f"/root/testdata/sf{a.sf}"
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    bad = 0
    for name, fn in QUERIES.items():
        if a.names and not any(name.startswith(n) for n in a.names):
            continue
        t0 = time.time()
        try:
            got = fn(spark, d).toPandas()
        except Exception as exc:  # noqa: BLE001
            print(f"ERROR {name}: {str(exc)[:1500]}")
            bad += 1
            continue
        dt = time.time() - t0
        if name not in ORACLES:
            print(f"rows  {name}: {len(got)} rows {dt:.1f}s")
            continue
        try:
            want = con.execute(ORACLES[name]).df()
        except Exception as exc:  # noqa: BLE001
            print(f"SQLERR {name}: {str(exc)[:1200]}")
            bad += 1
            continue
        gc, gr = rows_of(got)
        wc, wr = rows_of(want)
        dup = "" if len(gr) else "  (EMPTY)"
        kinds = [(c, str(got[c].dtype), str(want[c].dtype)) for c in gc if c in wc and got[c].dtype.kind != want[c].dtype.kind]
        if gc == wc and gr == wr and not kinds:
            print(f"ok    {name}: {len(gr)} rows {dt:.1f}s{dup}")
            continue
        bad += 1
        diff = [(g, w) for g, w in zip(gr, wr) if g != w]
        print(f"DIFF  {name}: rows {len(gr)} vs {len(wr)}; differing {len(diff)}; types {kinds} {dt:.1f}s")
        if gc != wc:
            print("   columns", gc, wc)
        print("   ", gc)
        for g, w in diff[:3]:
            print("    got ", g)
            print("    want", w)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
