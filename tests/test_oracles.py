"""Every query with an SQL counterpart gives its rows."""

import pytest

from lockstep.plans import registry
from oracle import DATA, compare


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_rows(spark, name):
    compare(spark, registry.QUERIES[name], registry.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() >= 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
