"""Registered queries against DuckDB on the smallest tables (all of them with ORRERY_ALL=1)."""

import os

import duckdb
import pytest

from orrery.plans import load_all
from orrery.plans.registry import ORACLES, QUERIES
from tools.check import TABLES, rows_of

load_all()
D = "/root/testdata/sf0.001"
QUICK = "j01_ j05_ j06_ j17_ w02_ w04_ l02_ l04_ a12_ a15_ q01_ q16_ d04_ t01_ t05_ v04_ v09_ s01_ s02_ s04_ s06_ s14_ t04_ t11_d t15_ t16_ s16_ k03_ r03_ r06_ u03_ o02_".split()
NAMES = [n for n in ORACLES if os.environ.get("ORRERY_ALL") or any(n.startswith(q) for q in QUICK)]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_against_sql(spark, con, name):
    assert rows_of(QUERIES[name](spark, D).toPandas()) == rows_of(con.execute(ORACLES[name]).df())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) >= 211


def test_values_just_below_a_tie_fall_in_the_same_decade(spark, tmp_path):
    import duckdb
    from __spark_entry__ import oracle_sql, queries

    ties = [(2498.75, 0.09), (995.0, 0.06), (995.0, 0.04), (24998.75, 0.09), (100001.25, 0.09), (80001.0, 0.1), (1234.56, 0.05), (24997.5, 0.09), (98765.43, 0.0)]
    rows = ", ".join(f"({p!r}::DOUBLE, {q!r}::DOUBLE)" for p, q in ties)
    small = "/root/testdata/sf0.001"
    duckdb.execute(f"COPY (SELECT l.* REPLACE (p AS l_extendedprice, q AS l_discount, 1 AS l_linenumber) FROM (SELECT * FROM '{small}/lineitem.parquet' LIMIT 20) l, (VALUES {rows}) x(p, q)) TO '{tmp_path}/lineitem.parquet'")
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path if t == 'lineitem' else small}/{t}.parquet'")
    got = queries()["a35_log_histogram_and_pivot"](spark, str(tmp_path))
    want = con.execute(oracle_sql()["a35_log_histogram_and_pivot"]).df()[got.columns]
    assert sorted(map(tuple, got.collect())) == sorted(want.itertuples(index=False, name=None))
