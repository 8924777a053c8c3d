"""Every query with SQL against DuckDB on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, bool) or v is None or isinstance(v, str):
        return str(v)
    return f"{float(v):.6f}" if not math.isnan(float(v)) else "nan"


@pytest.mark.parametrize("name", sorted(entry_module.oracle_sql()))
def test_query_matches_sql(spark, db, name):
    got = entry_module.queries()[name](spark, SF)
    columns = sorted(got.columns)
    mine = sorted(tuple(_plain(v) for v in r) for r in got.select(*[f"`{c}`" for c in columns]).collect())
    found = db.execute(entry_module.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    theirs = sorted(tuple(_plain(r[i]) for i in at) for r in found.fetchall())
    assert mine == theirs
    assert mine or name in ("containment_match",)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
