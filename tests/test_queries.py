from __future__ import annotations

import pytest

from parcelight.plans import data_queries, detection_queries, source_queries, vector_queries

from .compare import assert_same
from .conftest import DATA

RUNS = {k: v for m in (data_queries, vector_queries, detection_queries, source_queries) for k, v in m.queries().items()}
SQL = {k: v for m in (data_queries, vector_queries, detection_queries, source_queries) for k, v in m.oracle_sql().items()}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    assert_same(spark, DATA, RUNS[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(RUNS) - set(SQL)))
def test_runs(spark, name):
    df = RUNS[name](spark, DATA)
    assert df.columns and df.count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
