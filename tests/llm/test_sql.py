"""Queries against their SQL, and that native ones stay native."""

import pytest

from checks import compare
from tapewire.llm.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def connection(small):
    return compare.duck(small)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, connection, small, name, monkeypatch):
    monkeypatch.setitem(compare.QUERIES, name, QUERIES[name])
    monkeypatch.setitem(compare.ORACLE, name, ORACLE[name])
    assert compare.compare(spark, connection, name, small) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES if n != "pipeline") == list(range(1, 14))


@pytest.mark.parametrize("name", ["op7_quotation_linking", "op8_temporal_url_lists"])
def test_native_queries_run_no_python(spark, small, name, capsys):
    QUERIES[name](spark, small).explain()
    plan = capsys.readouterr().out
    for word in ("Python", "Pandas", "Arrow", "Cartesian", "BroadcastNestedLoop"):
        assert word not in plan
