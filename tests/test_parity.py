"""Every registered query against its SQL, over the whole tables."""

from __future__ import annotations

import pytest
from conftest import SF_DIR
from parity import compare, connect

import __spark_entry__ as contract
from chartlake.registry.base import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert set(df.columns) == {"id", "ranking_date", "position", "artist"}
    assert df.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    _, wrong = compare(QUERIES[name](spark, SF_DIR), duck, ORACLES[name])
    assert wrong == ""
