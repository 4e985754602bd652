"""Every registered query of the engine against its SQL on the smallest tables."""

import pytest

from frames import same_rows
from riverglass.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_sql(spark, duck, data, name):
    same_rows(catalog.QUERIES[name](spark, data).toPandas(), duck.execute(catalog.ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_query_without_sql_runs(spark, data, name):
    assert catalog.QUERIES[name](spark, data).count() > 0


def test_entry_has_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_sql_has_queries():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
