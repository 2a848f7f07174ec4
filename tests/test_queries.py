"""Every registered query against its check statement, on the smallest data folder."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from tests.compare import connect, differences

QUERIES, SQL = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    if name in SQL:
        assert differences(frame, duck, SQL[name]) is None
    else:
        assert frame.count() > 0


def test_statements_belong_to_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
