"""Every catalogue query against its DuckDB SQL on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from tidemark.plans import catalogue

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS FROM read_parquet('{f}')")
    return con


def norm(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return ""
    return repr(round(x, 6)) if isinstance(x, float) else str(x)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    frame = catalogue.QUERIES[name](spark, FOLDER)
    columns = sorted(frame.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in frame.collect())
    if name in catalogue.ORACLE_SQL:
        want = duck.sql(catalogue.ORACLE_SQL[name])
        assert sorted(want.columns) == columns
        place = [want.columns.index(c) for c in columns]
        assert got == sorted(tuple(norm(r[k]) for k in place) for r in want.fetchall())


def test_band_join_has_no_cartesian_product(spark):
    plan = catalogue.band_pairs(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
