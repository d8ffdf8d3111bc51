"""The pipeline against plain versions of its stages, and the contract of the registered queries."""

import zlib

import numpy as np

import corpus_pipeline
from mobility.llm import decontaminate, quality, registry, tokens
from mobility.llm.common import table as read
from mobility.llm.common import written
from tests.llm.brute import SF, duck, edge_docs, empty_docs, secrets, similar, table


def test_stages_match_plain_versions(spark):
    docs = read(spark, SF, "documents")
    columns = docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    stage = dict(corpus_pipeline.STAGES)

    kept = stage["quality_rules"](spark, docs, SF)
    want = duck(quality.SQL.format(source="documents"), documents=table(SF, "documents"))
    texts = {r["doc_id"]: r["text"] for r in want if r["kept"]}
    assert kept.columns == columns and {r.doc_id: r.text for r in kept.collect()} == texts

    kept = written(kept, "a")
    single = stage["near_duplicates"](spark, kept, SF)
    first = set(similar(texts, 80, 5).values())
    assert single.columns == columns and {r.doc_id for r in single.collect()} == first

    single = written(single, "b")
    clean = stage["decontamination"](spark, single, SF)
    found = duck(decontaminate.SQL.format(source="documents"), documents=single.toArrow(), benchmark=table(SF, "benchmark"))
    left = {r["doc_id"] for r in found if not r["contaminated"]}
    assert clean.columns == columns and {r.doc_id for r in clean.collect()} == left

    clean = written(clean, "c")
    masked = stage["secrets_masked"](spark, clean, SF)
    assert masked.columns == columns
    out = {r.doc_id: r for r in masked.collect()}
    assert set(out) == left
    for i, r in out.items():
        assert secrets(r.text) == [] and r.n_chars == len(r.text)
        assert r.text == texts[i] or secrets(texts[i])

    masked = written(masked, "d")
    rows = stage["packed_sequences"](spark, masked, SF).collect()
    encode = tokens.Encoder(tokens.vocabulary())
    for i, r in out.items():
        ids = np.array(encode.tokenizer.encode(r.text, add_special_tokens=False).ids + [0], "<u4")
        own = sorted((p for p in rows if p.doc_id == i), key=lambda p: p.piece)
        assert [p.ids_crc32 for p in own] == [zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for p in own]
        assert sum(p.length for p in own) == len(ids)


def test_stages_on_edge_and_empty_tables(spark):
    for docs, n in ((edge_docs(spark), 1), (empty_docs(spark), 0)):
        at = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            at = written(stage(spark, at, SF), name)
            assert at.schema == docs.schema
        rows = corpus_pipeline.STAGES[-1][1](spark, at, SF).collect()
        assert bool(rows) == bool(n)


def test_one_query_an_operator():
    names = list(registry.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
    assert set(registry.oracle_sql()) <= set(names)


def test_run_is_the_stages_in_a_row(spark):
    at = read(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = written(stage(spark, at, SF), name)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    want = corpus_pipeline.STAGES[-1][1](spark, at, SF).select(columns).collect()
    got = corpus_pipeline.run(spark, SF).select(columns).collect()
    assert sorted(got) == sorted(want) and got
