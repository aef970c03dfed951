"""Every trial query against its SQL, on the smallest tables."""

from __future__ import annotations

import os
import sys

import pytest

import __spark_entry__ as contract
from trials.catalog import QUERIES
from trials.check import differences
from trials.expected import SQL

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="needs the test tables")


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert differences(spark, TABLES, name) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_other_queries_stay_where_the_text_part_cannot_be_imported(monkeypatch):
    """Not there at all, or there with something missing that it needs."""
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    assert "pipeline" not in contract.queries()
    for module in ("harbor.llm.queries", "harbor.llm.expected"):
        with monkeypatch.context() as inner:
            inner.setitem(sys.modules, module, None)
            assert contract.queries().keys() == QUERIES.keys()
            assert contract.oracle_sql().keys() == SQL.keys()
