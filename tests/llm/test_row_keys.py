"""Results must not depend on how the splits of a table fall in one pass or the other."""

import itertools

import pytest

from mobility.llm import common, decontaminate, jaccard_join, secret_scan, suffix_dedup
from mobility.llm.common import table
from tests.llm.brute import SF, as_rows, documents
from tests.plan_text import plan_text

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def moving_splits(spark, monkeypatch):
    """Every table that an operator writes has other splits than the one before, as after a change of executors."""
    sizes = itertools.cycle([30_000, 40_000, 55_000, 100_000, 200_000, 25_000, 20_000])

    def write(df, name, **options):
        spark.conf.set(SPLIT, next(sizes))
        return plain(df, name, **options)

    plain = common.written
    before = spark.conf.get(SPLIT)
    for module in (common, jaccard_join, suffix_dedup):
        monkeypatch.setattr(module, "written", write)
    yield
    spark.conf.set(SPLIT, before)


@pytest.mark.parametrize("operator", [jaccard_join.query, jaccard_join.one_of_each, suffix_dedup.query])
def test_changed_splits_change_nothing(spark, operator, request):
    want = as_rows(operator(documents(spark)))
    request.getfixturevalue("moving_splits")
    assert as_rows(operator(documents(spark))) == want


@pytest.mark.parametrize("operator", ["clean_documents", "masked_documents", "secret_scan"])
def test_joins_by_the_key_read_stored_keys(spark, operator):
    docs = documents(spark)
    got = {
        "clean_documents": lambda: decontaminate.clean_documents(docs, table(spark, SF, "benchmark")),
        "masked_documents": lambda: secret_scan.masked_documents(docs),
        "secret_scan": lambda: secret_scan.query(docs),
    }[operator]()
    assert "monotonically_increasing_id" not in plan_text(got, "simple")
