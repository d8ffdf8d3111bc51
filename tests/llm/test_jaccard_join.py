import random

import numpy as np
import pytest

from mobility.llm import jaccard_join
from mobility.llm.common import keyed
from mobility.llm.components import components
from tests.llm.brute import LONG, PROSE, SHORT_TEXTS, components_of, documents, edge_docs, empty_docs, shingle_set, similar


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 112)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    real = [e for e in edges if e[0] != e[1]]
    assert got == components_of(real, {x for e in real for x in e})
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_documents_match_brute_force(spark):
    docs = documents(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = similar(texts)
    rows = jaccard_join.query(docs).collect()
    assert {r.doc_id: r.component_id for r in rows} == want
    assert all(r.n_shingles == len(shingle_set(texts[r.doc_id])) for r in rows)


def near_copies(n=120, edits=2):
    """One text and many copies with other words at other places, each near the first, few near each other."""
    rng = random.Random(6)
    words = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(words))]
    for i in range(1, n):
        copy = list(words)
        for at in rng.sample(range(150), edits + i % 4):
            copy[at] = f"x{i}-{at}"
        rows.append((i, " ".join(copy)))
    return rows


@pytest.mark.parametrize("percent,size", [(85, 4), (80, 5)])
def test_group_of_near_copies(spark, monkeypatch, percent, size):
    monkeypatch.setattr(jaccard_join, "HUB_SHARE", 16)
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.joined(keyed(docs), percent, size).collect()}
    assert got == similar(dict(rows), percent, size)
    assert len(set(got.values())) > 1  # some copies have too many edits


def passages_mixed(n=400, seed=3):
    """Texts of common lines that share a rarer passage: every list is long, few pairs link, some are near copies."""
    rng = random.Random(seed)
    lines = [" ".join(f"l{i}w{k}" for k in range(12)) for i in range(30)]
    rows = []
    for i in range(n):
        chosen = rng.sample(lines, rng.randint(1, 9))
        if rows and rng.random() < 0.2:
            chosen = rows[rng.randrange(len(rows))][1].split(" | ")[1:]
            chosen = [*chosen, rng.choice(lines)] if rng.random() < 0.5 else chosen[1:]
        tail = f"x{i}" if rng.random() < 0.7 else ""
        rows.append((i, " | ".join(["here is the shared passage", *chosen]) + f" {tail}"))
    return rows


@pytest.mark.parametrize("percent,size", [(85, 4), (60, 4)])
@pytest.mark.parametrize("levels", [0, 3])
def test_long_lists_lose_no_link(spark, monkeypatch, percent, size, levels):
    monkeypatch.setattr(jaccard_join, "LIST_PAIRS", 9)
    monkeypatch.setattr(jaccard_join, "LEVELS", levels)
    rows = passages_mixed(100)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.joined(keyed(docs), percent, size).collect()}
    assert got == similar(dict(rows), percent, size)
    assert len(set(got.values())) < len(rows) or percent == 85


def test_texts_that_share_a_passage_alone_do_not_meet(spark, monkeypatch):
    """3,000 texts with one common shingle in every prefix: their pairs would be 4.5 million."""
    rows = [(i, " ".join(["one and the same", *(f"w{i}x{k}" for k in range(30))])) for i in range(3_000)]
    monkeypatch.setattr(jaccard_join, "verified", lambda pairs, docs, *a, check=jaccard_join.verified: met.append(pairs.count()) or check(pairs, docs, *a))
    met = []
    docs = jaccard_join.stored(keyed(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    # the passage first: an order in which it is the rarest
    first = jaccard_join.shingles("one and the same")
    order = np.arange(1, jaccard_join.BUCKETS + 1, dtype=np.int32)
    order[jaccard_join._bucket(first)] = 0
    monkeypatch.setattr(jaccard_join, "bucket_counts", lambda *a: order)
    rows = jaccard_join.joined(docs).collect()
    assert len(rows) == 3_000 and sum(met) < 4 * 3_000


def test_texts_moved_round_a_hub(spark):
    # chains: each text is near the next only
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[i * 4 : i * 4 + 100])) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard_join.query(docs).collect()} == similar(dict(rows))


def test_edge_rows(spark):
    docs = edge_docs(spark, [*SHORT_TEXTS, (30, "ONE  Two"), (31, "one two three")])
    rows = jaccard_join.query(docs).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)
    n = len(shingle_set(PROSE))
    assert [g for g in got if g[0] in (1, 2)] == [(1, n, 1), (1, n, 1), (2, n + 6, 1)]
    assert [g for g in got if g[0] in (3, 4, 5)] == [(3, 0, 3), (4, 0, 4), (5, 0, 5)]
    assert [g for g in got if g[0] in (6, 7, 30, 31)] == [(30, 1, 6), (31, 1, 31), (6, 1, 6), (7, 1, 6)]
    assert [g[2] for g in got if g[0] is None] == [None]
    assert jaccard_join.query(empty_docs(spark)).collect() == []


def test_long_texts(spark):
    texts = [(8, LONG), (9, LONG + " and a few more words here"), (10, LONG[: len(LONG) // 2]), (11, PROSE)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.query(edge_docs(spark, texts)).collect()}
    want = similar(dict(texts))
    assert got == {i: (len(shingle_set(t)), want[i]) for i, t in texts} and want[9] == 8 != want[10]


def test_one_of_each_keeps_rows_and_columns(spark):
    docs = edge_docs(spark, SHORT_TEXTS)
    kept = jaccard_join.one_of_each(docs)
    assert kept.schema == docs.schema
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x or 0))
    assert ids == [1, 3, 4, 5, 6, 9, 10, 11, None]
