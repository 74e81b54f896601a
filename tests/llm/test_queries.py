from __future__ import annotations

import pytest

from parcelight.llm import queries

from ..compare import assert_same
from ..conftest import DATA

RUNS, SQL = queries.queries(), queries.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    assert_same(spark, DATA, RUNS[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(RUNS) - set(SQL)))
def test_runs(spark, name):
    assert RUNS[name](spark, DATA).count() > 0
