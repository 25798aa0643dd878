"""The correctness gate: every named query with an oracle equals DuckDB at sf0.001."""
import os

import pytest

import __spark_entry__ as E
from mixcast.plans.compare import compare, duck

SF = "/root/testdata/sf0.001"
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name](spark, SF), SQL[name])
    assert r["cols_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["hash_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "ROI" in df.columns
