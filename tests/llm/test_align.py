import bisect
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from mobility.llm import align, tokens
from tests.llm.brute import as_rows, documents, edge_docs, empty_docs

A, B = tokens.vocabulary("byte_bpe_50k.json"), tokens.vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabularies():
    first = tokens.Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = tokens.sentencepiece.SentencePieceProcessor(model_file=B)
    return first, second, tokens.Encoder(A, plain=True).token_bytes(), tokens.PieceEncoder(B).token_bytes()


def _ends(ids, size):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(size[i])))
        at += len(size[i])
    return out


def brute(texts, vocabularies):
    """Rows by whole-text encoding, comparing every token with every token of its group."""
    first, second, a_bytes, b_bytes = vocabularies
    docs = []
    for doc_id, text in texts:
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids
        b = second.encode(text or "")
        data = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[i] for i in a) != data or b"".join(b_bytes[i] for i in b) != data:
            docs.append((doc_id, None))
            continue
        x, y = _ends(a, a_bytes), _ends(b, b_bytes)
        common = sorted({e for _, e in x} & {e for _, e in y})
        groups = defaultdict(lambda: ([], []))
        for side, spans in enumerate((x, y)):
            for i, (_, e) in enumerate(spans):
                groups[bisect.bisect_left(common, e)][side].append(i)
        links = [
            (a[i], b[j]) for i_s, j_s in groups.values() for i in i_s for j in j_s if max(x[i][0], y[j][0]) < min(x[i][1], y[j][1])
        ]
        text = ";".join(",".join(str(a[i]) for i in i_s) + "|" + ",".join(str(b[j]) for j in j_s) for i_s, j_s in groups.values())
        docs.append((doc_id, (len(a), len(b), len(common), links, hashlib.sha256(text.encode()).hexdigest())))
    counts = Counter(p for _, d in docs if d for p in d[3])
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    out = []
    for doc_id, d in docs:
        if d is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
        else:
            best = sum(counts[p] == most[p[1]] for p in d[3])
            out.append((doc_id, *d[:3], len(d[3]), best, sum(counts[p] for p in d[3]), d[4]))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def pairs_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def test_ranks_are_those_of_a_binary_search():
    rng = random.Random(2)
    for _ in range(300):
        ends = np.cumsum([rng.choice([1, 1, 2, 9, 60]) for _ in range(rng.randint(1, 200))])
        short = np.array(sorted(rng.randint(1, int(ends[-1])) for _ in range(rng.randint(0, 60))), np.int64)
        assert align.ranks(short, ends).tolist() == np.searchsorted(ends, short).tolist()


def test_links_and_groups_of_random_cuts():
    rng = random.Random(4)

    def cut(total):
        at = sorted(rng.sample(range(1, total), rng.randint(0, total - 1))) if total > 1 else []
        return np.diff([0, *at, total])

    for _ in range(200):
        totals = [rng.randint(1, 30) for _ in range(rng.randint(1, 5))]
        a, b = [cut(t) for t in totals], [cut(t) for t in totals]
        got = align.Alignment(np.concatenate(a), np.concatenate(b), np.array(list(map(len, a))), np.array(list(map(len, b))))
        x, y = np.cumsum(np.concatenate(a)), np.cumsum(np.concatenate(b))
        sx, sy = x - np.concatenate(a), y - np.concatenate(b)
        want = {(i, j) for i in range(len(x)) for j in range(len(y)) if max(sx[i], sy[j]) < min(x[i], y[j])}
        assert sorted(zip(got.a.tolist(), got.b.tolist())) == sorted(want)
        assert set(x[got.common[0]]) == set(y[got.common[1]]) == set(x) & set(y)
        assert sorted(np.concatenate(got.order()).tolist()) == list(range(len(x) + len(y)))


def test_matches_brute_force(spark, vocabularies):
    docs = documents(spark)
    assert found(align.query(docs)) == brute(pairs_of(docs), vocabularies)


PARTS = [" ", "  ", "\n", "\t", "a", "'s", "1", "#", " the", "日本", "\x85", " ", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x0A>",
         ".", "word ", "é", "́", "▁", "\x00", "👍🏽", "don't", "  x", "−"]


def test_awkward_texts(spark, vocabularies):
    rng = random.Random(9)
    texts = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 20)))) for i in range(400)]
    want = brute(texts, vocabularies)
    assert found(align.query(edge_docs(spark, texts))) == want
    assert any(r[1] == 0 for r in want) and any("▁" in t for _, t in texts)


def test_edge_rows(spark, vocabularies):
    docs = edge_docs(spark)
    assert found(align.query(docs)) == brute(pairs_of(docs), vocabularies)
    assert align.query(empty_docs(spark)).collect() == []
    none = edge_docs(spark, [(1, None), (2, ""), (3, "▁")])
    assert {r[1:] for r in found(align.query(none))} == {(0, 0, 0, 0, 0, 0, "")}


def test_pieces_and_rare_pairs_change_nothing(spark, monkeypatch):
    docs = edge_docs(spark)
    want = found(align.query(docs))
    for pairs in (0, 7, 300):  # the rest of the pairs is joined
        assert found(align.alignments(docs, A, B, max_pairs=pairs)) == want
    text = "The old house, by the river.\nIt's 1900  there " * 40
    aligner = align.Aligner(A, B)
    whole = aligner.align([text, None, "x", text + "▁"])
    monkeypatch.setattr(align, "PIECE_CHARS", 50)
    assert len(list(aligner._pieces(text))) > 20 and "".join(aligner._pieces(text)) == " " + text
    cut = aligner.align([text, None, "x", text + "▁"])
    assert [r[:5] for r in cut] == [r[:5] for r in whole] and cut[3] == (0, 0, 0, 0, "", b"")
    assert [sorted(np.frombuffer(r[5], aligner.code)) for r in cut] == [sorted(np.frombuffer(r[5], aligner.code)) for r in whole]


def test_counting_in_parts_changes_nothing(spark, monkeypatch):
    docs = documents(spark)
    want = as_rows(align.query(docs))
    monkeypatch.setattr(align, "COUNT_LINKS", 500)
    aligner = align.Aligner(A, B)
    links = spark.createDataFrame([(r[5],) for r in aligner.align([t for _, t in pairs_of(docs)])], "links binary")
    got = {r["code"]: r["n"] for r in align.pair_counts(links, aligner.code).collect()}
    codes = Counter(c for r in links.collect() for c in np.frombuffer(r["links"], aligner.code).tolist())
    assert got == dict(codes) and want
