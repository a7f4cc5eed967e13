"""Every query against its SQL on another engine."""

import pytest

from tarmac.catalog import QUERIES
from tarmac.verification import compare
from tarmac.verification.oracle import ORACLE_SQL


@pytest.fixture(scope="module")
def con(folder):
    return compare.connect(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, folder, name):
    assert compare.differences(spark, con, folder, name) == []


def test_differences_are_found(spark, con, folder, monkeypatch):
    monkeypatch.setitem(ORACLE_SQL, "topk", ORACLE_SQL["topk"].replace("LIMIT 15", "LIMIT 14"))
    assert compare.differences(spark, con, folder, "topk") == ["15 rows instead of 14"]
    monkeypatch.setitem(ORACLE_SQL, "fn_hour", "SELECT event_id, hour(ts) + 1 AS value FROM events")
    assert len(compare.differences(spark, con, folder, "fn_hour")) == 5
