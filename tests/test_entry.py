import pytest

import __spark_entry__ as E
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
QS, SQL = E.queries(), E.oracle_sql()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 1000
    assert {"mean_fare_window_1h_pickup_zip", "dropoff_is_weekend", "fare_amount"} <= set(df.columns)


def test_registry_consistent():
    assert set(SQL) <= set(QS)
    assert len(QS) >= 40


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QS[name], SQL[name], SF)
    assert r["status"] in ("exact", "close"), r
