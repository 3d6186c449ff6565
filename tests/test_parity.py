"""Every registered query against its SQL on the smallest driver tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from compare import connect, differences
from workload import oracle
from workload import queries as registered

SF = entry_point.SMOKE_DIR
QUERIES, ORACLE = registered.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_parity(spark, duck, name):
    found = differences(spark, duck, name, QUERIES[name], ORACLE[name], SF)
    assert not found, "\n".join(found)
