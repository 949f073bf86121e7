"""Every query with an oracle SQL matches DuckDB on sf0.001 (rows, types, values)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle_harness import compare, duck_connection

SF = "/root/testdata/sf0.001"
SQLS = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, queries()[name], SQLS[name], SF)
    assert res["schema_ok"], res
    assert res["spark_rows"] == res["duck_rows"], res
    assert res["values_ok"], res
    assert not res["cross_join"], res


def test_every_query_runs(spark):
    for name, fn in queries().items():
        if name not in SQLS:
            assert fn(spark, SF).count() >= 0


def test_entry(spark):
    df = entry(spark)
    assert df.count() == 5 and "Segmentation" in df.columns
