"""Every registered query that has SQL agrees with DuckDB at the smallest scale."""

from __future__ import annotations

import pytest

from pitval.queries import ORACLES, QUERIES, callables
from tests.oracle_check import compare, duck

FOLDER = "/root/testdata/sf0.001"
#: These fit 200 boosted trees as gbt_predict does, minutes each: ``python -m tests.oracle_check`` runs them.
LONG = {"evaluation_frame_model", "model_blend", "model_comparison"}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("key", sorted(set(ORACLES) - LONG))
def test_query_equals_its_sql(spark, con, key):
    assert compare(callables()[key](spark, FOLDER), con, ORACLES[key]) == ""


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() >= 0
    assert set(contract.queries()) >= set(QUERIES)
