"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from tests.compare import difference, duck
from tidewatch.plans.registry import all_queries, all_sql

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = all_queries(), all_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_points_hold_them():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None
