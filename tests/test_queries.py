"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_module
from scripts.check_queries import compare, connect
from workload import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", [key for key in ORACLES if key in entry_module.queries()])
def test_query_agrees_with_sql(spark, connection, key):
    problem, _, _ = compare(spark, connection, SF_DIR, key)
    assert problem is None


def test_entry_and_registration(spark):
    assert entry_module.entry(spark).count() > 0
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_module.queries().keys() and ORACLES.keys() <= entry_module.oracle_sql().keys()
