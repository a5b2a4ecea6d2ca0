from __future__ import annotations

import check
import pytest

import __spark_entry__ as spark_entry
from conftest import SF
from standin.checks import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return check.connection(SF)


def test_entry(spark):
    assert spark_entry.entry(spark).limit(1).count() == 1


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query(spark, con, name):
    ok, note = check.compare(spark, con, SF, name)
    assert ok, note
