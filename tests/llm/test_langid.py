import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from mobility.llm import langid
from tests.llm.brute import LONG, documents, edge_docs, empty_docs


def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    langs = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = langid.query(docs).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows} <= set(langs.values())


def test_prediction_reads_the_text_only(spark):
    docs = documents(spark)
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    some = docs.limit(20)
    moved = some.selectExpr("doc_id + 1000 AS doc_id", "text", "'xx' AS lang", "'other' AS source")
    a = sorted((r.doc_id, r.lang_pred, r.score) for r in langid.predicted(some, model).collect())
    b = sorted((r.doc_id - 1000, r.lang_pred, r.score) for r in langid.predicted(moved, model).collect())
    assert a == b


def test_edge_rows(spark):
    rows = langid.query(edge_docs(spark)).collect()
    und = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert und == {3, 4, 5}
    assert all(r.score == 0 and r.rejected for r in rows if r.doc_id in und)
    assert langid.query(empty_docs(spark)).collect() == []
    unlabelled = edge_docs(spark).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in langid.query(unlabelled).collect()} == {"und"}


def test_blocks_count_like_the_whole(monkeypatch):
    rng = random.Random(2)
    texts = [LONG[:20_000], "", "a", "ab", "é", " . ", "ΑΣ ΑΣ", "İstanbul I", *(
        "".join(rng.choice("ab  .éΣß1") for _ in range(rng.randint(1, 60))) for _ in range(300)
    )]
    whole = [langid.term_counts(t) for t in texts]
    for size in (1, 2, 3, 7, 1000):
        monkeypatch.setattr(langid, "BLOCK_CHARS", size)
        for t, w in zip(texts[1 if size < 7 else 0 :], whole[1 if size < 7 else 0 :]):
            assert (langid.term_counts(t) == w).all(), (size, t)


def plain_counts(text):
    """Feature counts by Python's own loops."""
    codes = [32]
    for c in map(ord, text.lower() + " "):
        letter = 97 <= c <= 122 or (c >= 0xAA and c not in (0xD7, 0xF7) and not 0x2000 <= c < 0x2C00)
        if letter or codes[-1] != 32:
            codes.append(c if letter else 32)
    counts = Counter()
    for n in (1, 2, 3):
        for i in range(len(codes) - n + 1):
            gram = codes[i : i + n]
            if set(gram) != {32}:
                value = 0
                for c in gram:
                    value = (value << 21) + c
                h = ((value + n) * 0x9E3779B97F4A7C15) % 2**64
                h = ((h ^ h >> 29) * 0xBF58476D1CE4E5B9) % 2**64
                counts[h >> 52] += 1
    return counts


def test_predictions_are_those_of_a_plain_nearest_centroid(spark):
    docs = documents(spark)
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    assert len(model.centres) > len(model.languages) > 1
    for r in langid.predicted(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect():
        counts = plain_counts(r.text or "")
        vector = {f: (1 + math.log(n)) * float(model.idf[f]) for f, n in counts.items()}
        norm = math.sqrt(sum(v * v for v in vector.values()))
        if not norm:
            assert r.lang_pred == "und"
            continue
        cosines = [sum(v * float(c[f]) for f, v in vector.items()) / norm for c in model.centres]
        assert abs(max(cosines) - r.score) < 1e-4
        near = {model.languages[model.owner[i]] for i, c in enumerate(cosines) if c > max(cosines) - 1e-4}
        assert r.lang_pred in near


@pytest.mark.parametrize("doc_id", [None, 1, 2, 3])
def test_rows_that_share_an_id_all_count(spark, doc_id):
    rows = [(doc_id, f"the house and the river {i}", "en") for i in range(3000)]
    rows += [(doc_id, f"la maison et la rivière où {i}", "fr") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert model.languages == ["en", "fr"]
    got = langid.predicted(docs, model).groupBy("lang_pred").count().collect()
    assert {r.lang_pred: r["count"] for r in got} == {"en": 3000, "fr": 3000}
    equal = spark.createDataFrame([(doc_id, "one text", "en")] * 6000, docs.schema)
    chosen, share = langid.sampled(equal, 50)
    assert share == 50 and langid.fit(equal, 50).languages == ["en"]


def test_no_language_is_lost(spark):
    rng = random.Random(4)
    rows = [(i, " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(3)), f"l{i % 3000}") for i in range(9000)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), k=1)
    assert len(model.languages) == 3000 and len(model.centres) == 3000


def test_sample_is_bounded_and_even(spark):
    rows = [(i, f"text {i}", "big" if i % 50 else "small") for i in range(5000)]
    chosen, share = langid.sampled(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 120)
    got = {r.lang: r["count"] for r in chosen.groupBy("lang").count().collect()}
    assert share == 60 and got == {"big": 60, "small": 60}


def test_distant_texts_are_rejected(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    model = langid.fit(docs.select("doc_id", "text", "lang"))
    names, scores, accepted = model.predict(["это русский текст и больше ничего " * 20])
    assert not accepted[0] and scores[0] < 0.2
    kept = langid.predicted(docs, model).filter("NOT rejected").count()
    assert kept > 0.9 * docs.count()
