import pytest

import __spark_entry__ as E
from tools.check_oracle import compare, duck
from tradewatch.plans.catalog import QUERIES
from tradewatch.plans.oracle import ORACLE

from conftest import SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 936
    assert "open" in df.columns and "buy_sell_ratio" in df.columns


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, name):
    con = duck(SF001)
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF001)
    assert r["ok"], r
