"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_points
from querybook import QUERIES

from . import oracle

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert {r.value for r in rows} <= {"A", "N", "R"} and len(rows) > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = entry_points.queries()[name](spark, FOLDER)
    assert oracle.differences(df, con, entry_points.oracle_sql()[name]) is None
