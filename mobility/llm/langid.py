"""Language identification by nearest centroid over TF-IDF vectors of character n-grams.

The features of a text are the hashed 1-, 2- and 3-grams of its letters (lower
case, runs of other characters as one blank).  Document frequencies are counted
over every training row of the corpus; each language's training vectors are
grouped into several spherical k-means centroids on a bounded sample: SAMPLE rows
spread evenly over the languages, at least one of each, those with the least
hashes of id and text.  The model holds every language, so that the sample is of
as many rows as there are languages where these are more than SAMPLE.  A text gets the language of the centroid with the highest
cosine; it is rejected where that cosine is below what nearly all (``QUANTILE``)
training texts of that language and of similar length reach, or where no
feature is known.

Defined cases: a null text or one without a letter is ``und`` with score 0;
whole texts are read, in blocks that count like the whole, however long; ties go
to the first language in sorted order; rows may share an id or have none; rows without a language never train; repeated rows are
predicted each on its own; an empty table, or one without training rows,
gives ``und`` for every row; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobility.llm.common import ROW, keyed, ship, written

UNKNOWN = "und"
#: Hashed features.
FEATURES = 1 << 12
#: Training rows from which the centroids are fitted, and centroids per language.
SAMPLE = 2400
CENTROIDS = 4
ROUNDS = 12
#: Share of the sample that a rejection threshold accepts.
QUANTILE = 0.995
#: Characters taken at a time from a text, and texts of a block of vectors.
BLOCK_CHARS = 1 << 18
TEXTS = 128


def _letters(text: str) -> np.ndarray:
    """The code points of a lower-cased text, those that are no letter as blanks."""
    raw = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    letter = ((raw >= 97) & (raw <= 122)) | ((raw >= 0xAA) & (raw != 0xD7) & (raw != 0xF7) & ~((raw >= 0x2000) & (raw < 0x2C00)))
    return np.where(letter, raw, np.uint64(32))


def _grams(codes: np.ndarray, seen: int) -> np.ndarray:
    """Hashed features of the 1-, 2- and 3-grams that have a letter and do not end within the first ``seen`` codes."""
    out = []
    for n in (1, 2, 3):
        own = codes[max(seen - n + 1, 0) :]
        if len(own) < n:
            break
        value, some = np.zeros(len(own) - n + 1, np.uint64), np.zeros(len(own) - n + 1, bool)
        for k in range(n):
            part = own[k : len(own) - n + 1 + k]
            value = value * np.uint64(1 << 21) + part
            some |= part != 32
        hashed = (value + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        out.append((hashed >> np.uint64(64 - FEATURES.bit_length() + 1))[some])
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def term_counts(text: str) -> np.ndarray:
    """Feature counts of the whole text between blanks, runs of blanks as one.

    Blocks hand their last two codes on, which is what a later gram can reach.
    """
    text = text.lower()
    total = np.zeros(FEATURES, np.int64)
    seen = np.array([32], np.uint64)
    for at in range(0, len(text) + 1, BLOCK_CHARS):
        block = text[at : at + BLOCK_CHARS]
        new = _letters(block if at + BLOCK_CHARS <= len(text) else block + " ")
        new = new[(new != 32) | (np.concatenate([seen[-1:], new[:-1]]) != 32)]
        codes = np.concatenate([seen, new])
        total += np.bincount(_grams(codes, len(seen)), minlength=FEATURES)
        seen = codes[-2:]
    return total


def _vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """Normalised rows of (1 + log tf) * idf."""
    tf = np.stack([term_counts(t) for t in texts])
    return _normalised(np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0).astype(np.float32) * idf)


def _normalised(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return rows / np.where(norm > 0, norm, 1)


def centroids(vectors: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means; starts from the mean, then from the row least like any centre so far."""
    centres = _normalised(vectors.mean(axis=0, keepdims=True))
    while len(centres) < min(k, len(vectors)):
        likeness = (vectors @ centres.T).max(axis=1)
        centres = np.vstack([centres, vectors[likeness.argmin()][None]])
    for _ in range(rounds):
        nearest = (vectors @ centres.T).argmax(axis=1)
        centres = _normalised(
            np.stack([vectors[nearest == c].mean(axis=0) if (nearest == c).any() else centres[c] for c in range(len(centres))])
        )
    return centres


@dataclass
class Model:
    """languages[owner[c]] owns centroid c; floor: lowest accepted cosine of a language by log2 of the letters."""

    languages: list[str]
    owner: np.ndarray
    centres: np.ndarray
    idf: np.ndarray
    floor: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(languages, cosines, accepted) of texts that have a letter."""
        vectors = _vectors(texts, self.idf)
        cosines = vectors @ self.centres.T
        best = cosines.argmax(axis=1)  # the first of equal ones: centroids are sorted by language
        score = np.clip(cosines[np.arange(len(texts)), best], 0, 1)
        owner = self.owner[best]
        accepted = (score > 0) & (score >= self.floor[owner, [_size(t) for t in texts]])
        return [self.languages[o] for o in owner], score, accepted


SIZES = 12


def _size(text: str) -> int:
    return min(len(text).bit_length() // 2, SIZES - 1)


def is_held_out(id_col: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """(rows, rows that have each feature) over all of ``texts``: a row a task and feature is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(FEATURES, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df += term_counts(text) > 0
                n += 1
        if n:
            feature = np.concatenate([[-1], np.flatnonzero(df)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(feature, pa.int64()), pa.array(np.concatenate([[n], df[df > 0]]), pa.int64())], names=["feature", "n"]
            )

    rows = texts.mapInArrow(count, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(FEATURES, np.int64)
    for r in rows:  # at most FEATURES + 1 rows
        if r["feature"] >= 0:
            df[r["feature"]] = r["n"]
    return next((r["n"] for r in rows if r["feature"] < 0), 0), df


def _draw() -> Column:
    return F.xxhash64("doc_id", "text", F.lit(7))


def sampled(training: DataFrame, sample: int = SAMPLE) -> tuple[DataFrame, int]:
    """((lang, draw, text) rows from which ``share`` of every language are to be taken, share).

    A language's count gives the part of the hashes among which its least ones
    surely or nearly are; its least hash is always among them.  What passes is
    ranked in two narrow columns, and the texts below a language's cut are
    returned, more than ``share`` only where rows are equal.
    """
    stats = written(training.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(_draw()).alias("least")), "languages")
    share = max(sample // max(stats.count(), 1), 1)
    part = (_draw().cast("double") + 2.0**63) / 2.0**64
    near = training.select("lang", _draw().alias("draw"), part.alias("part")).join(stats, "lang")
    near = near.filter((F.col("part") * F.col("n") < 16 * share) | (F.col("draw") == F.col("least")))
    first = Window.partitionBy("lang").orderBy("draw")
    cut = near.select("lang", "draw", F.row_number().over(first).alias("rank")).filter(F.col("rank") <= share)
    cut = written(cut.groupBy("lang").agg(F.max("draw").alias("cut")), "cuts")
    chosen = training.select("lang", _draw().alias("draw"), "text").join(cut, "lang").filter("draw <= cut")
    return chosen.select("lang", "draw", "text"), share


def fit(docs: DataFrame, sample: int = SAMPLE, k: int = CENTROIDS) -> Model | None:
    """Learns from (doc_id, text, lang) rows; None if none can train."""
    ship(docs.sparkSession)
    training = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    n, df = document_frequencies(training.select("text"))
    if not n:
        return None
    idf = np.log((1 + n) / (1 + df)).astype(np.float32)
    idf[df == 0] = 0
    idf += (df > 0) * np.float32(0.1)  # a feature of every text still counts a little

    def vectorise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, draw, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                vector = _vectors([text], idf)[0].astype(np.float16).tobytes()
                yield pa.RecordBatch.from_pylist([{"lang": lang, "draw": draw, "size": _size(text), "vector": vector}])

    chosen, share = sampled(training, sample)
    vectors = chosen.mapInArrow(vectorise, "lang string, draw long, size long, vector binary")
    first = Window.partitionBy("lang").orderBy("draw", "vector")
    rows = vectors.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= share).collect()
    languages = sorted({r["lang"] for r in rows})
    owner, centres, floor = [], [], np.zeros((len(languages), SIZES), np.float32)
    for i, lang in enumerate(languages):
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: r["vector"])
        vectors = np.stack([np.frombuffer(r["vector"], np.float16) for r in own]).astype(np.float32)
        found = centroids(vectors, k)
        owner += [i] * len(found)
        centres.append(found)
        reach, size = (vectors @ found.T).max(axis=1), np.array([r["size"] for r in own])
        for s in range(SIZES):  # fewer than 20 texts of a length say nothing about it
            near = reach[size == s]
            floor[i, s] = 0.9 * np.quantile(near, 1 - QUANTILE) if len(near) >= 20 else 0
    return Model(languages, np.array(owner), np.vstack(centres), idf, floor)


def predicted(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, doc_id, lang_pred, score, rejected) of every row of ``docs``; only its text decides.

    ``rejected`` texts carry the nearest language, for callers who want it anyway.
    """
    rows = keyed(docs, id_col, text_col)
    lettered = F.when(F.col("text").rlike(r"\p{L}"), F.col("text"))
    if model is None:
        return rows.select(ROW, "doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                texts = part.column(2).to_pylist()
                some = [i for i, t in enumerate(texts) if t is not None]
                lang, score, rejected = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
                if some:
                    for i, name, cosine, accepted in zip(some, *model.predict([texts[i] for i in some])):
                        lang[i], score[i], rejected[i] = name, float(cosine), not accepted
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(lang), pa.array(score, pa.float64()), pa.array(rejected)],
                    names=[ROW, "doc_id", "lang_pred", "score", "rejected"],
                )

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.select(ROW, "doc_id", lettered.alias("text")).mapInArrow(
        predict, f"{ROW} long, doc_id {kind}, lang_pred string, score double, rejected boolean"
    )


def query(docs: DataFrame) -> DataFrame:
    model = fit(docs.filter(~is_held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))
    return predicted(docs, model).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
