"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from starweave.plans import catalogue, streams
from tests.compare import difference, oracle

SF = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()
LIBRARY = {**catalogue.BATCH, **streams.STREAMS}


def test_every_query_has_sql():
    assert set(LIBRARY) <= set(SQL)


@pytest.mark.parametrize("name", list(LIBRARY))
def test_matches_sql(spark, name):
    got = contract.queries()[name](spark, SF).toPandas()
    assert len(got) > 0
    assert difference(got, oracle(SQL[name], SF)) is None


def test_entry(spark):
    df = contract.entry(spark)
    assert "order_id" in df.columns and df.count() == 1473
