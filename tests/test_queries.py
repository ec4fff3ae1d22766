"""Every query with checking SQL gives the same rows in Spark and DuckDB."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare

QUERIES, ORACLES = queries(), oracle_sql()
#: Whole fits of a minute or more: check.py compares them, and test_nodes and test_models test their operators.
LONG = {"boosted_trees", "calibrated_ensemble", "resumed_search"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - LONG))
def test_same_rows_as_duckdb(name, spark, duck, sf_dir):
    state, text, _ = compare(spark, name, QUERIES[name], ORACLES[name], sf_dir, duck)
    assert state == "ok", text


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry(spark)
    assert len(df.columns) == 48
    assert df.count() > 0
