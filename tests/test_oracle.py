"""Every registered query with SQL equals that SQL on DuckDB, on the smallest tables."""

from __future__ import annotations

import os
import sys

import pytest
from conftest import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check_oracle  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from rainloom.catalog.oracle import SQL  # noqa: E402
from rainloom.catalog.queries import QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, con, name):
    good, note = check_oracle.compare(spark, con, name, SF)
    assert good, note


def test_entry_and_keys(spark):
    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) - set(SQL) == {
        "iterative_impute", "train_score", "grid_search", "batch_predict", "replay_predict", "stream_score"}


def test_imputed_table_is_complete(spark):
    from rainloom.catalog.derived import ID, observations
    from rainloom.schema import NUMERIC_COLUMNS

    got = queries()["iterative_impute"](spark, SF)
    given = observations(spark, SF).select(*ID)
    assert got.count() == given.count() and given.exceptAll(got.select(*ID)).count() == 0
    assert got.dropna(subset=NUMERIC_COLUMNS).count() == got.count()
