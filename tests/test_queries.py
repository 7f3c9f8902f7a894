import pytest

import __spark_entry__
from snpspark import queries as core

SQL = core.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(name, agrees):
    agrees(core.queries()[name], SQL[name])


def test_every_query_without_sql_runs(spark, sf):
    for name in sorted(set(core.queries()) - set(SQL)):
        assert core.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
