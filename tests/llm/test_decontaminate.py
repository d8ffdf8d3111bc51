import pytest
from pyspark.sql import functions as F

from mobility.llm import decontaminate
from mobility.llm.common import keyed
from tests.llm.brute import LONG, PROSE, SHORT_TEXTS, SF, as_rows, documents, duck, edge_docs, empty_docs, same, table
from tests.plan_text import plan_text


def test_matches_sql(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    want = duck(decontaminate.ORACLE, documents=table(SF, "documents"), benchmark=table(SF, "benchmark"))
    got = decontaminate.query(documents(spark), items)
    assert as_rows(got) == same(want)
    assert any(r.contaminated for r in got.collect())
    plan = plan_text(got, "simple")
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


WORDS = PROSE.split()
ITEMS = {
    "long": [(1, " ".join(WORDS[5:30])), (2, " ".join(WORDS[5:30])), (3, "nothing like it " * 6), (4, None), (5, ""), (None, " ".join(WORDS[20:40]))],
    "short": [(1, "The HOUSE by"), (2, "river"), (3, " ".join(WORDS[3:25])), (4, "one two"), (5, "wörld 你好")],
    "none": [],
    "blank": [(1, None), (2, " .,")],
}


@pytest.mark.parametrize("which", ITEMS)
@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_MAX_BYTES, 0])
def test_edge_rows_on_both_joins(spark, which, limit):
    docs = edge_docs(spark, SHORT_TEXTS)
    items = spark.createDataFrame(ITEMS[which], "item_id long, text string")
    found = decontaminate.matches(keyed(docs), items, limit)
    got = {(r["_row"]): (r.doc_id, r.n_words, decontaminate_hits(r.hits), sorted(r["items"])) for r in found.collect()}
    sql = decontaminate.SQL.format(source="documents")
    want = duck(sql, documents=docs.select("doc_id", "text").toArrow(), benchmark=items.toArrow())
    assert sorted(map(repr, ((i, n, h, len(x)) for i, n, h, x in got.values()))) == sorted(
        repr((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"])) for r in want
    )
    if limit:
        assert as_rows(decontaminate.query(docs, items)) == same(want, drop=("text",))
    assert decontaminate.query(empty_docs(spark), items).collect() == []


def test_large_benchmarks_shuffle_what_may_match(spark):
    """Past the bound: merge join although the tables are small, the same rows, and few fingerprints before the exchange."""
    items, docs = spark.read.parquet(f"{SF}/benchmark.parquet"), documents(spark)
    want = as_rows(decontaminate.matches(keyed(docs), items))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = decontaminate.matches(keyed(docs), items, 0)
        assert as_rows(found) == want
        plan = plan_text(found, "simple")
        final = plan.split("== Initial Plan ==")[0]
        assert "SortMergeJoin" in final and final.count("BroadcastHashJoin") == 1  # the bits
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    words = docs.select("doc_id", decontaminate.words_of(docs["text"]).alias("words"))
    codes = words.select("doc_id", "words", F.explode(decontaminate.fingerprints(F.col("words"), 13)).alias("code"))
    grams = codes.select("doc_id", decontaminate._hash(F.col("code")).alias("hash"))
    hashes = decontaminate.benchmark_windows(items, 13).select("hash")
    kept = decontaminate.with_set_bits(grams, hashes)
    real = grams.join(hashes.distinct(), "hash", "left_semi").count()
    assert real <= kept.count() <= real + 0.03 * grams.count()


@pytest.mark.parametrize("per_hash, most", [(64, 1 << 27), (1, 1 << 16)])
def test_bits_lose_no_hash(spark, monkeypatch, per_hash, most):
    monkeypatch.setattr(decontaminate, "BITS_PER_HASH", per_hash)
    monkeypatch.setattr(decontaminate, "MOST_BITS", most)
    hashes = spark.range(100_000).selectExpr("xxhash64(id) & 8589934591 AS hash").union(spark.sql("SELECT -5L AS hash"))
    assert decontaminate.with_set_bits(hashes, hashes.filter("hash >= 0")).count() == 100_001
    none = decontaminate.with_set_bits(hashes, hashes.limit(0))
    assert [r.hash for r in none.collect()] == [-5]


def decontaminate_hits(hits):
    return len({p for start, size in hits for p in range(start, start + size)})


def test_clean_documents_keep_rows_and_columns(spark):
    docs = edge_docs(spark)
    items = spark.createDataFrame(ITEMS["long"], "item_id long, text string")
    clean = decontaminate.clean_documents(docs, items)
    assert clean.schema == docs.schema
    gone = sorted(set(map(repr, docs.select("doc_id").collect())) - set(map(repr, clean.select("doc_id").collect())))
    assert gone == ["Row(doc_id=1)", "Row(doc_id=2)", "Row(doc_id=8)"]


def test_long_text(spark):
    items = spark.createDataFrame([(1, " ".join(WORDS[5:30]))], "item_id long, text string")
    row = decontaminate.query(edge_docs(spark, [(8, LONG)]), items).first()
    assert (row.n_hit, row.n_items) == (25 * 3000, 1) and row.contaminated


def test_guarantee_of_winnowing(spark):
    # every 13-word window of an item is found wherever it stands
    import random

    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)]
    item = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(150):
        start = rng.randrange(48)
        text = [rng.choice(vocabulary) for _ in range(rng.randrange(30))] + item[start : start + 13]
        rows.append((i, " ".join(text + [rng.choice(vocabulary) for _ in range(rng.randrange(30))])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = decontaminate.query(docs, items)
    assert got.filter("n_hit < 13").count() == 0
    assert as_rows(got) == same(duck(decontaminate.SQL.format(source="documents"), documents=docs.toArrow(), benchmark=items.toArrow()), drop=("text",))
