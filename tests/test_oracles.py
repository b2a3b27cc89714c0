"""Every registered query against its DuckDB oracle on the smallest tables (in-process DuckDB)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import compare, duck_connection  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duck_connection(SF)
    yield con
    con.close()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, key):
    sdf = QUERIES[key](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLES[key])
    drows = res.fetchall()
    assert compare(sdf.columns, srows, [d[0] for d in res.description], drows) == ""
