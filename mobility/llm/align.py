"""Cross-tokenizer alignment by galloping intersection of token ends.

Two tokenizers cut the same bytes.  The shorter of a document's two sorted lists
of token ends drives the search: each of its ends is sought in the longer list
by exponential steps from where an earlier end was found and a binary search
between the last two.  Ends found in both lists cut the document into groups.
The ranks that the search gives also say which tokens overlap: a token reaches
from the rank of its start to the rank of its end.

The searches of a batch run in step: all even multiples of a stride are known
when the odd ones start from the multiple before, for strides that halve.
Documents lie behind each other on one byte axis, on which both lists meet at
every document's end.

Counts of linked id pairs cover the whole corpus.  Every task sums its own
pairs first, and Spark sums those.  A pair's count goes back to the documents
with a broadcast of the frequent pairs, at most PAIRS of them; where there are
more, the rare rest is joined to the documents that hold it, with equal rows.

Defined cases: null and empty texts, and texts whose tokens of either kind do
not give back their bytes, have no tokens (zeros, an empty digest); texts of
any length are aligned whole, long ones piece by piece between common ends;
repeated rows are aligned each on its own and their links count each time;
pairs whose counts tie for the highest of their second id are all best; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import ROW, keyed, ship, written
from mobility.llm.tokens import CACHE_BYTES, ID, PIECE_CHUNK, VISIBLE, ChunkEncoder, Encoder, PieceEncoder, vocabulary

#: Characters aligned at once (a longer stretch only where a text has no place to cut).
PIECE_CHARS = 1 << 20
#: Links whose pairs a counting task sums at once, and distinct pairs it holds.
COUNT_LINKS = 1 << 21
#: Id pairs whose counts are broadcast, 17 bytes each.
PAIRS = 1 << 21

#: Both tokenizers cut here whatever is around it.
_PLACE = re.compile(f"(?<=[^ ])(?= [{VISIBLE}])")


# ------------------------------------------------------------------ the search


def _gallop(values: np.ndarray, start: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each value the first place of ``ends`` at or after its start that is not below it."""
    low, high, step, last = start.copy(), start.copy(), 1, len(ends) - 1
    todo = np.flatnonzero(ends[high] < values)
    while len(todo):
        at = high[todo]
        low[todo] = at + 1
        at = np.minimum(at + step, last)
        high[todo] = at
        step *= 2
        todo = todo[ends[at] < values[todo]]
    todo = np.flatnonzero(low < high)
    while len(todo):
        a, b = low[todo], high[todo]
        middle = (a + b) >> 1
        below = ends[middle] < values[todo]
        a, b = np.where(below, middle + 1, a), np.where(below, b, middle)
        low[todo], high[todo] = a, b
        todo = todo[a < b]
    return high


def ranks(short: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of ``ends`` are below each of ``short``; both ascend, and no value is above the last end."""
    found = np.zeros(len(short), np.int64)
    if not len(short):
        return found
    found[:1] = _gallop(short[:1], found[:1], ends)
    stride = 1 << (len(short) - 1).bit_length()
    while stride > 1:
        stride //= 2
        odd = np.arange(stride, len(short), 2 * stride)
        found[odd] = _gallop(short[odd], found[odd - stride], ends)
    return found


def _ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, ... of each size, one after the other."""
    return np.arange(sizes.sum()) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)


class Alignment:
    """Documents with their token sizes in both lists; every document has tokens, of equal bytes on both sides."""

    def __init__(self, a_sizes: np.ndarray, b_sizes: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
        heads = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b  # the first token of every document
        self.common = np.zeros(len(a_sizes), bool), np.zeros(len(b_sizes), bool)
        links = []
        for short, long, drives in ((0, 1, n_a <= n_b), (1, 0, n_a > n_b)):
            size = (n_a, n_b)[short][drives]
            token = _ranges(heads[short][drives], size)
            rank = ranks(ends[short][token], ends[long])
            both = ends[long][rank] == ends[short][token] if len(token) else np.zeros(0, bool)
            first = np.concatenate([[0], (rank + both)[:-1]]) if len(token) else rank
            first[np.cumsum(size) - size] = heads[long][drives]
            self.common[short][token[both]] = True
            self.common[long][rank[both]] = True
            n = rank - first + 1
            links.append((np.repeat(token, n), _ranges(first, n)))
        (a1, b1), (b2, a2) = links
        #: Indices of the linked tokens.
        self.a, self.b = np.concatenate([a1, a2]), np.concatenate([b1, b2])

    def order(self) -> tuple[np.ndarray, np.ndarray]:
        """Where each token comes if every group lists its first tokens, then its second ones."""
        out = []
        last = [np.flatnonzero(c) + 1 for c in self.common]
        for mine, other, here in ((0, 1, 0), (1, 0, 1)):
            group = np.cumsum(self.common[mine]) - self.common[mine]
            before = np.concatenate([[0], last[other]])
            out.append(np.arange(len(group)) + before[group + here])
        return out[0], out[1]


# ------------------------------------------------------------------- documents


class ChunkPairs(ChunkEncoder):
    """Both lists of ids of a chunk as bytes, by one cache; ``lossy`` holds the chunks that they do not give back."""

    def __init__(self, first: Encoder, second: PieceEncoder, cache_bytes: int = CACHE_BYTES):
        super().__init__(cache_bytes)
        self.both = first, second
        self.bytes = first.token_bytes(), second.token_bytes()
        self.cuts = first.cuts and second.cuts
        self.lossy: set[str] = set()

    def chunks(self, text: str) -> list[str]:
        """Chunks of both; without two spaces in a row the two patterns cut alike."""
        return PIECE_CHUNK.findall(text) if self.cuts else [text]

    def fresh(self, chunk: str) -> tuple[bytes, bytes]:
        first, second = self.both
        found = first.fresh(chunk), second.fresh(chunk)
        if not self._kept(chunk, found):
            self.lossy.add(chunk)
        return found

    def cost(self, chunk: str, found: tuple[bytes, bytes]) -> int:
        return 260 + 3 * len(chunk) + len(found[0]) + len(found[1])

    def _kept(self, text: str, found: tuple[bytes, bytes]) -> bool:
        data, (first, second) = text.encode(), self.bytes
        a, b = (memoryview(ids).cast("I") for ids in found)
        return b"".join([first[i] for i in a]) == data == b"".join([second[i] for i in b])

    def pair(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Both lists of ids of a text, or None if either does not give back its bytes."""
        chunks = self.chunks(text)
        found = tuple(map(b"".join, zip(*map(self.__getitem__, chunks))))
        if self.lossy and not self.lossy.isdisjoint(chunks) and not self._kept(text, found):
            return None
        return tuple(np.frombuffer(ids, ID).astype(np.int64) for ids in found)


class Aligner:
    """Aligns texts under two vocabularies; links are codes (first id times the second's size, plus second id)."""

    def __init__(self, a_path: str, b_path: str):
        self.pairs = ChunkPairs(Encoder(a_path, 0, plain=True), PieceEncoder(b_path, 0))
        sizes = [np.fromiter(map(len, b), np.int64, len(b)) for b in self.pairs.bytes]
        self.sizes, self.n_second = sizes, len(sizes[1])
        self.code = code_type(len(sizes[0]), self.n_second)
        digits = [str(i).encode() for i in range(max(map(len, sizes)))]
        self.width = len(digits[-1])
        self.digits = np.array(digits, f"S{self.width}").view(np.uint8).reshape(len(digits), self.width)
        self.n_digits = np.fromiter(map(len, digits), np.int64, len(digits))

    def _pieces(self, text: str) -> Iterator[str]:
        """The text after a space, cut between common ends."""
        text = " " + text
        at = 0
        while self.pairs.cuts and len(text) - at > PIECE_CHARS:
            place = _PLACE.search(text, at + PIECE_CHARS)
            if place is None:
                break
            yield text[at : place.start()]
            at = place.start()
        yield text[at:]

    def align(self, texts: list[str | None]) -> list[tuple]:
        """(n_a, n_b, n_groups, n_links, digest, codes of the links as bytes) of every text."""
        docs = [_Document() for _ in texts]
        waiting, size = [], 0
        for doc, text in zip(docs, texts):
            for piece in self._pieces(text) if text else ():
                ids = self.pairs.pair(piece)
                if ids is None:
                    doc.lost = True
                    break
                waiting.append((doc, *ids))
                size += len(piece)
                if size >= PIECE_CHARS:
                    self._add(waiting)
                    waiting, size = [], 0
        self._add(waiting)
        return [d.row() for d in docs]

    def _add(self, pieces: list[tuple]) -> None:
        pieces = [p for p in pieces if not p[0].lost]
        if not pieces:
            return
        n_a, n_b = (np.array([len(p[i]) for p in pieces]) for i in (1, 2))
        a, b = (np.concatenate([p[i] for p in pieces]) for i in (1, 2))
        found = Alignment(self.sizes[0][a], self.sizes[1][b], n_a, n_b)
        codes = (a[found.a] * self.n_second + b[found.b]).astype(self.code)
        owner = np.repeat(np.arange(len(pieces)), n_a)[found.a]
        codes = codes[np.argsort(owner, kind="stable")]
        n_links = np.bincount(owner, minlength=len(pieces))
        groups = np.add.reduceat(found.common[0], np.cumsum(n_a) - n_a, dtype=np.int64)
        text, ends = self._listed(a, b, found, n_a + n_b)
        start = link = 0
        for (doc, *_), *n, links, end in zip(pieces, n_a.tolist(), n_b.tolist(), groups.tolist(), n_links.tolist(), ends):
            doc.add(n, codes[link : link + links], text[start:end])
            start, link = end, link + links

    def _listed(self, a: np.ndarray, b: np.ndarray, found: Alignment, n: np.ndarray) -> tuple[bytes, list[int]]:
        """The pieces' groups as text, each piece with a closing semicolon, and where each piece ends."""
        first, second = found.order()
        ids, mark = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[first], ids[second] = a, b
        mark[first[found.common[0]]], mark[second[found.common[1]]] = ord("|"), ord(";")
        size = self.n_digits[ids]
        text = np.zeros((len(ids), self.width + 1), np.uint8)
        text[:, : self.width] = self.digits[ids]
        text[np.arange(len(ids)), size] = mark
        text = text.ravel()
        return text[text != 0].tobytes(), np.cumsum(size + 1)[np.cumsum(n) - 1].tolist()


class _Document:
    """What is known of one document while its pieces come in."""

    def __init__(self):
        self.n, self.codes, self.hash, self.lost, self.open = np.zeros(3, np.int64), [], hashlib.sha256(), False, False

    def add(self, n: list[int], codes: np.ndarray, groups: bytes) -> None:
        if self.open:
            self.hash.update(b";")
        self.open = True
        self.hash.update(groups[:-1])
        self.n += n
        self.codes.append(codes.tobytes())

    def row(self) -> tuple:
        if self.lost or not self.open:
            return (0, 0, 0, 0, "", b"")
        codes = b"".join(self.codes)
        n_links = int(self.n[0] + self.n[1] - self.n[2])  # each further token of a group adds one link
        return (*self.n.tolist(), n_links, self.hash.hexdigest(), codes)


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """The worker process's aligner."""
    return Aligner(a_path, b_path)


def code_type(n_first: int, n_second: int) -> np.dtype:
    """The narrowest little-endian type that holds every code."""
    return np.dtype("<u4") if n_first * n_second <= 1 << 32 else np.dtype("<u8")


# ------------------------------------------------------------- Spark operators

ALIGNED = f"{ROW} long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
TEXTS = 256


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row a ``keyed`` document; ``links`` holds the codes of its links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(a_path, b_path)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                *numbers, digest, links = zip(*both.align(part.column(2).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array(c, pa.int64()) for c in numbers],
                     pa.array(digest, pa.string()), pa.array(links, pa.binary())],
                    names=[ROW, "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links"],
                )

    ship(docs.sparkSession)
    return docs.select(ROW, F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ALIGNED)


def _summed(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes, their counts)."""
    if counts is None:
        return np.unique(codes, return_counts=True)
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    start = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[start], np.add.reduceat(counts, start)


def pair_counts(links: DataFrame, code: np.dtype) -> DataFrame:
    """(code, n) of every linked id pair over all ``links``, summed in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, size, held, distinct = [], 0, [], 0

        def gathered():
            held.append(_summed(np.concatenate(raw)))
            return len(held[-1][0])

        def out():
            codes, n = _summed(*map(np.concatenate, zip(*held)))
            return pa.RecordBatch.from_arrays([pa.array(codes.astype(np.int64)), pa.array(n)], names=["code", "n"])

        for batch in batches:
            for data in batch.column(0).to_pylist():
                if data:
                    raw.append(np.frombuffer(data, code))
                    size += len(raw[-1])
                if size >= COUNT_LINKS:
                    distinct += gathered()
                    raw, size = [], 0
                    if distinct >= 4 * COUNT_LINKS:
                        held = [_summed(*map(np.concatenate, zip(*held)))]
                        distinct = len(held[0][0])
                        if distinct >= 2 * COUNT_LINKS:  # mostly new pairs: Spark sums the rest
                            yield out()
                            held, distinct = [], 0
        if raw:
            gathered()
        if held:
            yield out()

    found = links.select("links").mapInArrow(count, "code long, n long")
    return found.groupBy("code").agg(F.sum("n").alias("n"))


class Frequent:
    """Counts of the frequent pairs, by binary search; ``best`` marks pairs with the highest count of their second id."""

    def __init__(self, codes: np.ndarray, n: np.ndarray, best: np.ndarray):
        order = np.argsort(codes)
        self.codes, self.n, self.best = codes[order], n[order], best[order]

    def seek(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of every code, whether it is there)."""
        place = np.searchsorted(self.codes, codes)
        place[place == len(self.codes)] = 0
        return place, (self.codes[place] == codes) if len(self.codes) else np.zeros(len(codes), bool)


SCORED = f"{ROW} long, n_best long, count_sum long"


def scored(rows: DataFrame, code: np.dtype, n_second: int, max_pairs: int = PAIRS) -> DataFrame:
    """(_row, n_best, count_sum) of every ``aligned`` row, from counts over all rows."""
    spark = rows.sparkSession
    counts = written(pair_counts(rows, code), "pairs").withColumn("second", F.col("code") % n_second)
    highest = counts.groupBy("second").agg(F.max("n").alias("most"))  # at most n_second rows
    most = np.zeros(n_second, np.int64)
    for r in highest.collect():
        most[r["second"]] = r["most"]
    # the least power of two that enough pairs are below: at most 64 rows
    power = F.floor(F.log2("n")).cast("int")
    sizes = {r["p"]: r["c"] for r in counts.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}
    least, total = 64, 0
    while least > 0 and total + sizes.get(least - 1, 0) <= max_pairs:
        least -= 1
        total += sizes.get(least, 0)
    frequent = power >= least
    head = counts.filter(frequent).select("code", "n").toArrow()
    codes, n = (head.column(i).to_numpy() for i in (0, 1))
    sent = spark.sparkContext.broadcast(Frequent(codes.astype(code), n, n == most[codes % n_second]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            out = []
            for data in batch.column(1).to_pylist():
                place, there = known.seek(np.frombuffer(data, code))
                place = place[there]
                out.append((int(known.best[place].sum()), int(known.n[place].sum())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in zip(*out)]], names=[ROW, "n_best", "count_sum"]
            )

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for row, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = np.frombuffer(data, code)
                rare, times = np.unique(codes[~known.seek(codes)[1]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rare), row)), pa.array(rare.astype(np.int64)), pa.array(times)],
                    names=[ROW, "code", "times"],
                )

    links = rows.select(ROW, "links")
    found = links.mapInArrow(score, SCORED)
    if not least:
        return found
    rare = counts.filter(~frequent).join(F.broadcast(highest), "second").select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    held = links.mapInArrow(rest, f"{ROW} long, code long, times long").join(rare, "code")
    more = held.groupBy(ROW).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum")
    )
    return found.unionByName(more).groupBy(ROW).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignments(
    docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", max_pairs: int = PAIRS
) -> DataFrame:
    """Every row's groups and links (see ``ALIGNED``) with n_best and count_sum."""
    sizes = Encoder(a_path, 0).tokenizer.get_vocab_size(), PieceEncoder(b_path, 0).processor.get_piece_size()
    rows = written(aligned(keyed(docs, id_col, text_col), a_path, b_path), "aligned", compression="zstd")
    return rows.join(scored(rows, code_type(*sizes), sizes[1], max_pairs), ROW)


def query(docs: DataFrame) -> DataFrame:
    found = alignments(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
