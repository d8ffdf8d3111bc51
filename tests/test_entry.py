"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as entry_module
from mobility.plans import registry


def test_entry_runs_flagship(spark):
    df = entry_module.entry(spark)
    rows = df.collect()
    assert df.columns == ["total"]
    assert len(rows) == 1 and rows[0].total is not None


def test_every_query_has_matching_oracle():
    queries, sql = registry.queries(), registry.oracle_sql()
    assert set(queries) == set(sql)
    assert len(queries) >= 67
    # the driver serves them all, and never SQL for a query it does not have
    assert set(queries) <= set(entry_module.queries())
    assert set(sql) <= set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_queries_have_stable_schema(spark):
    q = entry_module.queries()["pickups_by_zone_events"]
    a = q(spark, "/root/testdata/sf0.001").schema
    b = q(spark, "/root/testdata/sf0.01").schema
    assert a == b
