"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as contract
from compare import connect, difference
from tidemill.catalog import QUERIES as CATALOG

QUERIES = {name: q.run for name, q in CATALOG.items()}
SQL = {name: q.sql for name, q in CATALOG.items() if q.sql is not None}


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_contract_serves_the_catalog():
    served, twins = contract.queries(), contract.oracle_sql()
    assert set(QUERIES) <= set(served) and set(SQL) <= set(twins) <= set(served)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["time", "domain", "traffics"] and df.count() > 0


def test_approx_distinct_is_close(spark, sf_dir):
    exact = {r["event_type"]: r["users"] for r in QUERIES["distinct_per_group"](spark, sf_dir).collect()}
    approx = {r["event_type"]: r["users"] for r in QUERIES["approx_distinct"](spark, sf_dir).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - n) <= max(1, n * 0.1) for k, n in exact.items())
