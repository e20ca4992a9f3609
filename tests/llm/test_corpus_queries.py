"""The registered corpus queries against SQL, and their result columns."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from conftest import TEST_TABLES
from hiatus.llm.oracles import ORACLES
from hiatus.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    result = QUERIES[name](spark, TEST_TABLES)
    assert differences(result, connect(TEST_TABLES), ORACLES[name]) == []


def test_queries_are_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert "pipeline" in contract.queries()
