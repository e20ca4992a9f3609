"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from conftest import TEST_TABLES
from registry.oracles import ORACLES
from registry.queries import QUERIES


@pytest.fixture(scope="module")
def database():
    return connect(TEST_TABLES)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_comparison_notices_a_wrong_value(spark, database):
    result = contract.queries()["top_users"](spark, TEST_TABLES)
    wrong = contract.oracle_sql()["top_users"].replace("count(*) AS session_count", "count(*) + 1 AS session_count")
    assert differences(result, database, wrong)


def test_flagship_query(spark):
    assert contract.entry(spark).columns == [
        "artist_name",
        "track_name",
        "play_count",
        "session_count",
        "distinct_track_ids",
    ]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    result = contract.queries()[name](spark, TEST_TABLES)
    assert differences(result, database, contract.oracle_sql()[name]) == []
