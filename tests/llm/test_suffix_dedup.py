import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from mobility.llm import suffix_dedup
from tests.llm.brute import EDGE_TEXTS, LONG, SHORT_TEXTS, documents, edge_docs, empty_docs, repeated


def _pieces(rng, span):
    words = [bytes(rng.choice(b"ab\x00\xc3") for _ in range(rng.randint(1, 80))) for _ in range(4)]
    out = []
    for _ in range(rng.randint(1, 8)):
        piece = b"".join(rng.choice(words) for _ in range(rng.randint(1, 3)))
        piece += bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 10)))
        out.append(b"a" * rng.randint(span, 80) if rng.random() < 0.2 else piece)
    return [p for p in out if len(p) >= span]


def test_repeated_windows_match_counting():
    rng = random.Random(3)
    for _ in range(200):
        span = rng.choice([8, 16, 24, 40])
        pieces = _pieces(rng, span)
        if pieces:
            count = Counter(p[i : i + span] for p in pieces for i in range(len(p) - span + 1))
            want = [[count[p[i : i + span]] > 1 for i in range(len(p) - span + 1)] for p in pieces]
            assert [m.tolist() for m in suffix_dedup.repeated_windows(pieces, span)] == want


def test_suffix_order_is_sorted():
    rng = random.Random(8)
    for _ in range(100):
        text = np.array([rng.randint(1, 4) for _ in range(rng.randint(1, 60))] + [0], np.uint8)
        order = suffix_dedup.suffix_order(text, text > 0, span=64)
        want = sorted(range(len(text) - 1), key=lambda i: text[i:].tobytes())
        assert order.tolist() == want


def _check(docs):
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, *w) for r, w in zip(rows, repeated([r.text for r in rows]))]
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.query(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_documents_match_brute_force(spark):
    _check(documents(spark))


@pytest.mark.parametrize("limit", [suffix_dedup.ARRAY_BYTES, 1200, 0])
def test_edge_rows(spark, monkeypatch, limit):
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", limit)  # 0: every key is split
    rng = random.Random(1)
    prose = " ".join(str(rng.random()) for _ in range(60))
    texts = [*SHORT_TEXTS, (20, prose), (21, "x" + prose[:400]), (22, prose[100:300]), (23, prose[100:299]), (24, "é" * 150)]
    _check(edge_docs(spark, texts))
    assert suffix_dedup.query(empty_docs(spark)).collect() == []


@pytest.mark.parametrize("limit, depths", [(3000, suffix_dedup.DEPTHS), (0, (8,)), (0, ())])
def test_a_key_of_many_texts_is_split(spark, monkeypatch, limit, depths):
    """One passage among different neighbours, runs of one character of all lengths, and a period."""
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", limit)
    monkeypatch.setattr(suffix_dedup.split_ranges, "__defaults__", (depths,))
    rng = random.Random(5)

    def noise(n):
        return "".join(rng.choice("abcdefgh") for _ in range(n))

    mark, ends = noise(90), [noise(60) for _ in range(4)]
    texts = [noise(rng.randint(100, 200)) + rng.choice(ends) + mark + rng.choice(ends) + noise(rng.randint(100, 200)) for _ in range(60)]
    texts += [f"{noise(30)}{'a' * rng.randint(150, 900)}{noise(30)}" for _ in range(30)]
    texts += [f"{noise(5)}{(noise(7) if i % 2 else 'xyzabc') * 60}{noise(9)}" for i in range(10)]
    _check(edge_docs(spark, list(enumerate(texts))))


def test_a_period_is_few_ranges(spark, monkeypatch):
    """A text that repeats a short word is repeated as a whole: not a row for each time the word occurs."""
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", 0)
    rng = random.Random(9)
    text = "Is onhe. " * 250
    texts = [f"{rng.random()} {text[: rng.randint(1500, 2200)]} {rng.random()}" for _ in range(30)]
    texts += [f"{rng.random()} {(str(rng.random())[:9] + ' ') * 100} {rng.random()}" for _ in range(5)]
    docs = edge_docs(spark, list(enumerate(texts)))
    _check(docs)
    data = docs.selectExpr("doc_id AS _row", "CAST(text AS binary) AS data")
    counted = suffix_dedup.repeated_ranges(data).groupBy("_row").count().collect()
    assert len(counted) == len(texts)
    assert max(r["count"] for r in counted) <= 4 * (len(suffix_dedup.DEPTHS) + 1)


def test_pieces_are_not_written(spark, monkeypatch):
    """A split writes its runs, classes and keys; no table repeats the bytes that these hold."""
    monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", 0)
    names, write = [], suffix_dedup.written
    monkeypatch.setattr(suffix_dedup, "written", lambda df, name, **options: names.append(name) or write(df, name, **options))
    rng = random.Random(4)

    def noise(n):
        return "".join(rng.choice("abcdefgh") for _ in range(n))

    mark = noise(300)
    _check(edge_docs(spark, [(i, noise(150) + mark + noise(150)) for i in range(12)]))
    assert names == ["segments", "classes", "kinds", "wanted", *["runs", "classes", "kinds"] * len(suffix_dedup.DEPTHS), "runs", "classes"]


def test_merged_ranges():
    assert suffix_dedup.merged([]) == []
    assert suffix_dedup.merged([(0, 5), (1, 3), (5, 6), (7, 9), (8, 12)]) == [[0, 6], [7, 12]]


def test_finer_runs_tile_a_piece_and_keep_equal_windows_together():
    rng = random.Random(6)
    span = suffix_dedup.SPAN
    for _ in range(60):
        word = bytes(rng.choice(b"abc") for _ in range(rng.choice([1, 5, 40, 130])))
        data = b"".join(rng.choice([word, word * 3, bytes(rng.choice(b"ab") for _ in range(60))]) for _ in range(12))
        if len(data) < span:
            continue
        places = {}
        for start, n, key, *_ in suffix_dedup.segments(data):
            piece = data[start : start + n + span - 1]
            for depth in (*suffix_dedup.DEPTHS, 0):
                runs = list(suffix_dedup.finer_runs(key, 5, piece, depth))
                assert [s for s, _, _ in runs] == [0, *np.cumsum([m for _, m, _ in runs]).tolist()[:-1]]
                assert sum(m for _, m, _ in runs) == n
                for s, m, finer in runs:
                    for i in range(s, s + m):
                        places.setdefault((depth, key, piece[i : i + span]), set()).add(finer)
        assert all(len(keys) == 1 for keys in places.values())


def test_arrays_are_bounded():
    rng = random.Random(7)
    for _ in range(100):
        sizes = {k: [rng.randint(1, 50) for _ in range(rng.randint(1, 5))] for k in range(rng.randint(0, 30))}
        rows = [(k, sum(v), n) for k, v in sizes.items() for n in v]
        parts = list(suffix_dedup.arrays(iter(rows), 300))
        assert [r for part in parts for r in part] == rows
        assert all(sum(r[2] for r in part) <= 300 for part in parts)
        assert all(a[-1][0] != b[0][0] for a, b in zip(parts, parts[1:]))


def test_memory_of_an_array():
    pieces = [b"x" * 20_000 + bytes([97 + i % 20, 97 + i // 20]) * 300 for i in range(50)]
    pieces = pieces[: suffix_dedup.ARRAY_BYTES // 20_600]
    tracemalloc.start()
    suffix_dedup.repeated_windows(pieces)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 * suffix_dedup.ARRAY_BYTES


def test_long_text_in_blocks(spark, monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh ") for _ in range(30_000))
    twice = text + "|" + text
    keys = {s[2] for s in suffix_dedup.segments(twice.encode())}
    monkeypatch.setattr(suffix_dedup, "BLOCK_WINDOWS", 7_000)
    monkeypatch.setattr(suffix_dedup, "SEGMENT_WINDOWS", 50)
    cut = list(suffix_dedup.segments(twice.encode()))
    assert {s[2] for s in cut} == keys
    assert sum(s[1] for s in cut) == len(twice) - suffix_dedup.SPAN + 1
    row = suffix_dedup.query(edge_docs(spark, [(1, twice)])).first()
    assert row.n_removed == 2 * len(text) and row.n_spans == 2
    long = suffix_dedup.query(edge_docs(spark, [(8, LONG), EDGE_TEXTS[0]])).collect()
    assert [r.n_bytes for r in sorted(long, key=lambda r: r.doc_id)] == [len(EDGE_TEXTS[0][1]), len(LONG)]
    assert max(r.n_removed for r in long) > 0.9 * len(LONG)
