"""Every registered query runs; those with SQL give the same rows as DuckDB."""

from __future__ import annotations

import pytest
from oracle import compare, connect

from echoloom.registry import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None


@pytest.mark.parametrize("name", ["reduce_dims", "reduce_text", "project_2d", "predict_batch"])
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry_and_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns == ["review_id", "app_id", "content", "sentiment"]
    assert set(contract.oracle_sql()) <= set(contract.queries())
