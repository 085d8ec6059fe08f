"""Every registered query against its SQL twin, on the smallest data."""

import pytest

import __spark_entry__ as entry_module
from quotemill.plans import ORACLES, QUERIES, run

from .compare import check, engine


@pytest.fixture(scope="module")
def con(folder):
    return engine(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, folder, con, name):
    df = run(name, spark, folder)
    if name in ORACLES:
        assert check(df, con, ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_entry_and_contract(spark):
    assert entry_module.entry(spark).columns[:2] == ["ts_code", "trade_date"]
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
