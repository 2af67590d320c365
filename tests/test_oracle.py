"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from check_queries import compare, connect

import __spark_entry__ as entry
from weatherloom.bindings.registry import ORACLES, QUERIES

ROOT = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(ROOT).exists(), reason="given tables absent")


@pytest.fixture(scope="module")
def duck():
    return connect(ROOT)


def test_every_query_has_sql():
    """The optional subpackage has operators that SQL cannot express; its own tests cover them."""
    assert set(QUERIES) == set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert compare(entry.queries()[name](spark, ROOT), duck, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
