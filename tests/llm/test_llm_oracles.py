"""Queries with an SQL counterpart give its rows; the others run over whole tables."""

import pytest

from lockstep.llm import queries
from oracle import DATA, compare


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_rows(spark, name):
    assert compare(spark, queries.queries()[name], queries.oracle_sql()[name]) > 0


@pytest.mark.parametrize("name", sorted(set(queries.queries()) - set(queries.oracle_sql())))
def test_runs(spark, name):
    rows = queries.queries()[name](spark, DATA)
    assert rows.count() == spark.read.parquet(f"{DATA}/documents.parquet").count()
