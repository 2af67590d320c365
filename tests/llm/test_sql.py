"""The queries that SQL can express, against their SQL on whole small tables."""

from __future__ import annotations

import pytest
from check_queries import compare, connect

from weatherloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    assert compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None
