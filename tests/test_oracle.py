"""Every registered query against its SQL counterpart, on the whole small tables."""

import os

import pytest
from compare import compare, connect

from tillwise.catalog.registry import all_oracles, all_queries

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_a_counterpart():
    assert set(all_queries()) == set(all_oracles())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_matches_sql(spark, duck, name):
    assert compare(all_queries()[name](spark, FOLDER), duck, all_oracles()[name]) is None
