"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import os

import duckdb
import pytest

from mobility.plans.registry import REGISTRY
from tools.oracle_check import TABLES, duck_types, frame_hash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("query", [q for q in REGISTRY if q.sql], ids=lambda q: q.name)
def test_matches_oracle(spark, duck, query):
    df = query.build(spark, SF)
    assert dict(df.dtypes) == duck_types(duck, query.sql)
    got = df.toPandas()
    want = duck.execute(query.sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert frame_hash(got) == frame_hash(want)


def test_every_query_has_an_oracle():
    assert all(q.sql for q in REGISTRY)
