"""Every registered query against its SQL on the given tables."""

import pytest

from checks.compare import compare, duck
from checks.oracle import ORACLE
from checks.registry import QUERIES
from tapewire.operators.signals import SIGNAL_COLUMNS


@pytest.fixture(scope="module")
def connection(small):
    return duck(small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, small, name):
    assert compare(spark, connection, name, small) is None


def test_comparison_notices_a_difference(spark, connection, small, monkeypatch):
    sql = ORACLE["price_change"]
    monkeypatch.setitem(ORACLE, "price_change", sql.replace("round(pct, 6)", "round(pct + 1, 6)"))
    assert "against" in compare(spark, connection, "price_change", small)
    monkeypatch.setitem(ORACLE, "price_change", sql + " limit 5")
    assert "rows" in compare(spark, connection, "price_change", small)


def test_entry_points(spark):
    import __spark_entry__ as entry_module

    result = entry_module.entry(spark)
    assert result.columns == SIGNAL_COLUMNS
    assert result.count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert set(QUERIES) <= set(entry_module.queries())
