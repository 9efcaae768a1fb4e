"""Every registered query against its SQL, on tables large enough for full features."""

from __future__ import annotations

import os

import pytest

from checks.compare import spark_rows, sql_rows
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


def test_every_sql_belongs_to_a_query():
    assert set(ORACLES) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    columns, rows = spark_rows(spark, SF_DIR, name)
    want_columns, want = sql_rows(SF_DIR, ORACLES[name])
    assert columns == want_columns
    assert rows == want


def test_queries_without_sql_are_those_with_all_trees():
    """Their operators are checked with stumps, with the mean and by smaller models."""
    assert set(QUERIES) - set(ORACLES) == {
        "fit_forecaster", "score", "backtest", "next_forecast", "weekly_run",
    }
