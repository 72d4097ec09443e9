"""Every registered query against its DuckDB statement."""

import pytest

import __spark_entry__ as entry_points
import oracles
from starhouse.plans import catalog
from conftest import DATA
from oracle_compare import connect, differences

FOLDER = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracles.statements())
    assert set(catalog.QUERIES) <= set(entry_points.queries())
    assert set(oracles.statements()) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_oracle(spark, con, name):
    df = entry_points.queries()[name](spark, FOLDER)
    assert differences(df, con, entry_points.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    assert not entry_points.entry(spark).isEmpty()
