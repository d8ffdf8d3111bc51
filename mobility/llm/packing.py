"""Packing of documents into sequences: dominance reduction, then best fit.

A token sequence holds at most ``CAPACITY`` tokens, so the instance is, at any
corpus size, a histogram of at most ``CAPACITY`` lengths.  Martello and Toth's
reduction works on it: for a piece length it looks for a set of at most three
pieces that provably is at least as good as every other way of filling the
sequence that holds it, fixes that set as often as the counts allow, and goes
on with the smaller instance until nothing more can be fixed.  Best fit
decreasing packs the rest.  Both take equal lengths together, so the plan is a
short list of patterns with their number of repeats; only the histogram and
the patterns pass through the driver.

Spark does the rest at scale: every piece is ranked among the pieces of its
length (counted per salt, so that a length with a third of all pieces is
spread) and finds its sequence and offset from the rank by binary search.

Defined cases: a null or empty text is the end id alone; texts of any length are
encoded whole and cut from their end into full pieces, so that only the first
may be shorter; equal rows are packed each on its own; of pieces of one length
the order is by a hash of row and piece, then by row (any order fills the same
sequences); an empty table gives no sequence; extra
columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility.llm.common import ROW, keyed, ship, written
from mobility.llm.tokens import ID, encoder, vocabulary

CAPACITY = 2048
END_ID = 0
TEXTS = 64
#: Pieces of one length that one task ranks, in expectation.
SALT_PIECES = 1 << 14

PIECES = f"{ROW} long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


# ------------------------------------------------------------------ the plan


@dataclass
class Pattern:
    """``repeats`` sequences that each hold ``items``: (length, how many), in order."""

    items: list[tuple[int, int]]
    repeats: int

    @property
    def size(self) -> int:
        return sum(length * n for length, n in self.items)


@dataclass
class Plan:
    patterns: list[Pattern] = field(default_factory=list)
    n_reduced: int = 0

    @property
    def n_sequences(self) -> int:
        return sum(p.repeats for p in self.patterns)


def dominating_set(counts: np.ndarray, size: int) -> tuple[int, ...] | None:
    """A set with one piece of ``size`` that dominates every other set with it, or None.

    ``counts[s]`` pieces of length s are left (at least one of ``size``).  The
    set is proven best from what still fits beside the piece:
    nothing, a perfect fit, only one more piece, or at most two more pieces
    whose best pair is no larger than the largest single, or where the largest
    single and its best partner bound both members of every feasible pair.
    """
    room = len(counts) - 1 - size
    left = counts.copy()
    left[size] -= 1
    fits = np.flatnonzero(left[1 : room + 1] > 0) + 1
    if not len(fits):
        return (size,)
    large = int(fits[-1])
    if large == room:
        return (size, large)
    small = [int(s) for s in fits[:3] for _ in range(min(3, int(left[s])))][:3]
    if len(small) < 2 or small[0] + small[1] > room:
        return (size, large)
    if len(small) == 3 and sum(small) <= room:
        return None  # three more could fit: nothing is proven
    # at most two more pieces: the best pair
    best, low, high = 0, 0, len(fits) - 1
    while low <= high:
        pair = int(fits[low] + fits[high])
        if pair > room or (low == high and left[fits[low]] < 2):
            high -= 1
        else:
            best = max(best, pair)
            low += 1
    if best <= large:
        return (size, large)
    left[large] -= 1
    second = np.flatnonzero(left[1 : room - large + 1] > 0) + 1
    if not len(second):
        return None
    other = int(second[-1])
    above = fits[(fits > other) & (counts[fits] - (fits == size) > 0)]
    if not len(above) or 2 * int(above[0]) > room:
        return (size, large, other)  # every feasible pair x >= y has x <= large and y <= other
    return None


def reduced(counts: np.ndarray) -> list[Pattern]:
    """Fixes dominating sets in ``counts`` (changed in place) until none is left."""
    fixed = []
    again = True
    while again:
        again = False
        for size in range(len(counts) - 1, 0, -1):
            while counts[size] > 0 and (found := dominating_set(counts, size)):
                need = np.bincount(found, minlength=len(counts))
                repeats = int(min(counts[s] // need[s] for s in set(found)))
                counts -= need * repeats
                fixed.append(Pattern([(s, int(need[s])) for s in sorted(set(found), reverse=True)], repeats))
                again = True
    return fixed


def best_fit(counts: np.ndarray) -> list[Pattern]:
    """Best fit decreasing; equal pieces and equal sequences are handled together."""
    capacity = len(counts) - 1
    open_: dict[int, list[Pattern]] = defaultdict(list)  # by room left
    for size in range(capacity, 0, -1):
        left = int(counts[size])
        for room in sorted(r for r in open_ if r >= size):
            if not left:
                break
            each, waiting = room // size, open_.pop(room)
            while waiting and left:
                p = waiting.pop()
                full = min(p.repeats, left // each)
                if full:
                    open_[room - each * size].append(Pattern([*p.items, (size, each)], full))
                    left -= full * each
                    p.repeats -= full
                if p.repeats and left:  # less than one sequence's worth is left
                    open_[room - left * size].append(Pattern([*p.items, (size, left)], 1))
                    p.repeats, left = p.repeats - 1, 0
                if p.repeats:
                    waiting.append(p)
            if waiting:
                open_[room].extend(waiting)
        each = capacity // size
        if left // each:
            open_[capacity - each * size].append(Pattern([(size, each)], left // each))
        if left % each:
            open_[capacity - left % each * size].append(Pattern([(size, left % each)], 1))
    return [p for patterns in open_.values() for p in patterns]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Patterns that pack the histogram: reduction first, best fit for the remainder."""
    counts = np.zeros(capacity + 1, np.int64)
    for size, n in histogram.items():
        if not 1 <= size <= capacity:
            raise ValueError(f"a piece of {size} tokens does not fit {capacity}")
        counts[size] += n
    fixed = reduced(counts)
    out = Plan(fixed, sum(p.repeats for p in fixed))
    out.patterns = fixed + best_fit(counts)
    return out


def slots(packed: Plan) -> np.ndarray:
    """Rows (length, first rank, sequence, how many a sequence, offset), sorted by length and rank."""
    rank: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for p in packed.patterns:
        offset = 0
        for length, n in p.items:
            rows.append((length, rank[length], sequence, n, offset))
            rank[length] += n * p.repeats
            offset += length * n
        sequence += p.repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


# ----------------------------------------------------------- Spark operators


def pieces_of(docs: DataFrame, vocabulary_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """The pieces of every ``keyed`` document with their ids (little-endian unsigned 32-bit)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary_path)
        end = np.array([end_id], ID).tobytes()
        full = capacity * ID.itemsize
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                out: list[tuple] = []
                rows, ids = part.column(0).to_pylist(), part.column(1).to_pylist()
                for row, doc_id, data in zip(rows, ids, encode.encoded(part.column(2).to_pylist())):
                    data += end
                    first = len(data) % full or full
                    edges = [0, *range(first, len(data) + 1, full)]
                    for i, (a, b) in enumerate(zip(edges, edges[1:])):
                        piece = data[a:b]
                        out.append((row, doc_id, i, a // ID.itemsize, len(piece) // ID.itemsize, zlib.crc32(piece), piece))
                columns = list(zip(*out))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=[ROW, "doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    ship(docs.sparkSession)
    return docs.select(ROW, "doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(cut, PIECES)


def ranked(pieces: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """``pieces`` with ``rank``: 0, 1, ... among the pieces of the same length.

    A length is dealt out to as many salts as its pieces need, at most
    SALT_PIECES each in expectation.
    """
    salts = [(length, -(-n // SALT_PIECES)) for length, n in histogram.items()]  # a row a length
    salts = pieces.sparkSession.createDataFrame(salts, "length long, _salts long")
    salted = pieces.join(F.broadcast(salts), "length").withColumn("_salt", F.pmod(F.xxhash64(ROW, "piece"), F.col("_salts")))
    counts = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_salt").orderBy(ROW, "piece")
    return (
        salted.join(counts, ["length", "_salt"])
        .withColumn("rank", F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_salt", "_salts", "_before")
    )


def packed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (a written table with _row, piece, length) with sequence_id and offset.

    The histogram (at most ``capacity`` rows) and the patterns go through the driver.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = slots(plan(histogram, capacity))
    key = table[:, 0] * (1 << 48) + table[:, 1]  # ranks stay below 2^48
    fields = list(pieces.schema.fields)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            length = batch.column(names.index("length")).to_numpy(zero_copy_only=False)
            rank = batch.column(names.index("rank")).to_numpy(zero_copy_only=False)
            slot = table[np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1]
            within = rank - slot[:, 1]
            sequence = slot[:, 2] + within // slot[:, 3]
            offset = slot[:, 4] + within % slot[:, 3] * length
            columns = [batch.column(names.index(f.name)) for f in fields]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=[*[f.name for f in fields], "sequence_id", "offset"],
            )

    ship(pieces.sparkSession)
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked(pieces, histogram).mapInArrow(place, schema)


def pack(docs: DataFrame, vocabulary_path: str | None = None, id_col: str = "doc_id", text_col: str = "text"):
    """Every piece of ``docs`` with its ids and its place."""
    return packed(written(pieces_of(keyed(docs, id_col, text_col), vocabulary_path or vocabulary()), "pieces"))


def query(docs: DataFrame) -> DataFrame:
    found = written(pieces_of(keyed(docs), vocabulary()), "pieces")
    # the ids stay in the written table: only what the digest shows is ranked
    digest = packed(found.drop("ids"))
    return digest.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
