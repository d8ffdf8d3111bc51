"""Removal of repeated byte strings by suffix arrays.

Every byte is removed that lies in a SPAN-byte string which also starts
somewhere else in the corpus.  A window is SPAN bytes at one place; the work is
to find the windows that are equal to another one.

1. The least hash of the window's GRAM-byte strings is its key.  Equal windows
   have equal keys, and neighbouring windows mostly share theirs, so a text is
   a list of segments: maximal runs of windows with one key.  Every window
   lies in exactly one segment.  Keys are counted over the corpus; a key of one
   segment ends there.
2. Segments of a repeated key are classed by a 128-bit digest of their bytes.
   All windows of a class with two or more members are repeated.
3. One member of every class goes, by key, into a suffix array (two-stage
   sorting): suffixes smaller than their successors are sorted directly, the
   others are induced by scanning the buckets in order; windows next to each
   other whose common prefix reaches SPAN bytes are equal.  An array holds whole
   keys of at most ARRAY_BYTES together.
4. A key with more bytes is split over several tasks.  Equal windows have the
   string of their key at the same place, so they also agree in the DEPTHS[0]
   bytes before it, or after it where fewer are before.  Its segments are cut
   into runs of windows by that, with finer keys, classed, and sorted as above;
   what is still too large is cut by more bytes.  Keys that share all of these
   bytes and are still too large end in single windows, classed by digest.
5. Each text's repeated windows are joined to it, merged and cut out.

Defined cases: a null text is empty; texts shorter than SPAN have no window
and stay whole; matches never cross documents; repeated rows remove each
other's windows; ties cannot arise; an empty table gives an empty result; extra
columns are not read.  Very long texts are handled in blocks of windows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import BROADCAST_MAX_BYTES, ROW, keyed, ship, stored, written

SPAN = 200
#: Bytes of a hashed string within a window.
GRAM = 24
#: Windows handled at once in a text, and the most in one segment.
BLOCK_WINDOWS = 1 << 21
SEGMENT_WINDOWS = 1 << 15
#: Bytes of segments that one suffix array holds; sorting takes some 80 bytes of memory for each.
ARRAY_BYTES = 1 << 20
#: Bytes beside its string by which a larger key is split (at most half of what a window has besides).
DEPTHS = (8, 32, (SPAN - GRAM) // 2)
BROADCAST_ROWS = BROADCAST_MAX_BYTES // 64

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _sliding(values: np.ndarray, width: int, least=np.minimum) -> np.ndarray:
    """``least`` of every ``width`` neighbours, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = least(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return least(values[: len(values) - rest], values[rest:]) if rest else values


def gram_hashes(data: bytes, gram: int = GRAM) -> np.ndarray:
    """The hash of every ``gram`` bytes of ``data``."""
    n = len(data) - gram + 1
    words = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    hashed = words[:n] * _MIX[0]
    hashed ^= hashed >> np.uint64(32)
    for at, mix in zip(range(8, gram, 8), (_MIX[1], _MIX[2])):
        hashed += words[at : at + n]
        hashed *= mix
        hashed ^= hashed >> np.uint64(29)
    return hashed


def window_keys(data: bytes, span: int = SPAN, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(key of every window of ``data``, whether the key occurs again near that window)."""
    width = span - gram + 1
    hashed = gram_hashes(data, gram)
    keys = _sliding(hashed, width)
    # a string is some window's least if the greatest key of the windows around it is its hash
    around = np.concatenate([np.zeros(width - 1, np.uint64), keys, np.zeros(width - 1, np.uint64)])
    chosen = np.flatnonzero(_sliding(around, width, np.maximum) == hashed)
    again = np.flatnonzero((hashed[chosen[1:]] == hashed[chosen[:-1]]) & (chosen[1:] - chosen[:-1] <= width))
    mark = np.zeros(len(keys) + 1, np.int32)
    if len(again):
        np.add.at(mark, np.maximum(chosen[again] - width + 1, 0), 1)
        np.add.at(mark, np.minimum(chosen[again + 1] + 1, len(keys)), -1)
    return keys, np.cumsum(mark[:-1]) > 0


def digest(data: bytes) -> tuple[int, int]:
    """A 128-bit digest as two signed numbers."""
    return struct.unpack("<qq", xxhash.xxh3_128_digest(data))


def segments(data: bytes, span: int = SPAN) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(start, windows, key, digest, digest2, own) of every segment of a text; ``own``: it may repeat a window of itself."""
    total = len(data) - span + 1
    for at in range(0, max(total, 0), BLOCK_WINDOWS):
        n = min(BLOCK_WINDOWS, total - at)
        block = data[at : at + n + span - 1]
        keys, own = window_keys(block, span)
        keys = keys.view(np.int64)
        edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [n]])
        if (np.diff(edges) > SEGMENT_WINDOWS).any():
            edges = np.unique(np.concatenate([np.arange(a, b, SEGMENT_WINDOWS) for a, b in zip(edges, edges[1:])] + [[n]]))
        repeats = np.maximum.reduceat(own.astype(np.int8), edges[:-1]).tolist() if own.any() else [0] * (len(edges) - 1)
        for s, e, key, r in zip(edges[:-1].tolist(), edges[1:].tolist(), keys[edges[:-1]].tolist(), repeats):
            yield at + s, e - s, key, *digest(block[s : e + span - 1]), r


SEGMENT = f"{ROW} long, start long, windows long, key long, digest long, digest2 long, own long"
DIGEST = ["digest", "digest2"]


def segment_rows(docs: DataFrame) -> DataFrame:
    """One row a segment of every (_row, data) text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [
                    (row, *s)
                    for row, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                    for s in segments(data)
                ]
                if found:
                    names = [ROW, "start", "windows", "key", *DIGEST, "own"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=names)

    return docs.select(ROW, "data").mapInArrow(cut, SEGMENT)


# ---------------------------------------------------------------- suffix array


def _smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor (equal bytes decide like the byte after them; sentinels do)."""
    step = np.zeros(len(text), np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1])
    step[text == 0] = 1
    step[-1] = 1
    where = np.where(step != 0, np.arange(len(text)), len(text))
    following = np.minimum.accumulate(where[::-1])[::-1]
    return step[following] > 0


def _words(text: np.ndarray, span: int) -> np.ndarray:
    padded = np.concatenate([text, np.zeros(span + 8, np.uint8)])
    return np.ndarray((len(padded) - 7,), ">u8", padded.tobytes(), 0, (1,))


def _sorted_directly(words: np.ndarray, at: np.ndarray, span: int) -> np.ndarray:
    """``at`` in the order of the next ``span`` bytes: eight at a time, only what is still tied."""
    order = at[np.argsort(words[at], kind="stable")]
    tied = np.arange(len(order))  # places of the order that are not settled
    for depth in range(0, span, 8):
        key = words[order[tied] + depth].astype(np.uint64)
        if depth:
            by = np.lexsort((key, group))  # noqa: F821  ties of the last round stay together
            order[tied], key, group = order[tied][by], key[by], group[by]  # noqa: F821
        else:
            group = np.zeros(len(tied), np.int64)
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (group[1:] != group[:-1])])
        group = np.cumsum(new)
        alone = new & np.concatenate([new[1:], [True]])
        tied, group = tied[~alone], group[~alone]
        if not len(tied):
            break
    return order


def suffix_order(text: np.ndarray, wanted: np.ndarray, span: int = SPAN) -> np.ndarray:
    """The ``wanted`` places of ``text`` in suffix order (to ``span`` bytes).

    ``text`` holds bytes plus one, with a 0 after every segment; ``wanted`` is a
    mask.  Stage one sorts the suffixes that are smaller than their successors;
    stage two goes through the buckets (first bytes) in order and puts the
    larger suffix before each sorted one into its own bucket.  Places behind
    the last wanted one of a segment take part only as far as they are needed
    to induce it.
    """
    smaller = _smaller_than_next(text)
    # a larger suffix is induced from the next smaller one: what lies between is needed too
    count = np.cumsum(smaller)
    needed = wanted.copy()
    chain = np.flatnonzero(wanted & ~smaller)
    stop = np.flatnonzero(smaller)[count[chain]]  # the next smaller place after each
    mark = np.zeros(len(text) + 1, np.int64)
    np.add.at(mark, chain, 1)
    np.add.at(mark, stop + 1, -1)
    needed |= np.cumsum(mark[:-1]) > 0
    direct = _sorted_directly(_words(text, span), np.flatnonzero(needed & smaller), span)
    first = text[direct]
    edges = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    larger = needed & ~smaller
    out = []

    def hand_on(places: np.ndarray, bucket: int) -> np.ndarray:
        """Puts the larger predecessors into their buckets; returns those of this same bucket."""
        before = places[places > 0] - 1
        before = before[larger[before]]
        to = text[before]
        same = before[to == bucket]
        before, to = before[to != bucket], to[to != bucket]
        by = np.argsort(to, kind="stable")
        before, to = before[by], to[by]
        cuts = np.flatnonzero(to[1:] != to[:-1]) + 1
        for part, b in zip(np.split(before, cuts), to[np.concatenate([[0], cuts])] if len(to) else []):
            induced[b].append(part)
        return same

    for bucket in range(256):
        wave = np.concatenate(induced[bucket]) if induced[bucket] else np.zeros(0, np.int64)
        while len(wave):
            out.append(wave)
            wave = hand_on(wave, bucket)
        straight = direct[edges[bucket] : edges[bucket + 1]]
        if len(straight):
            out.append(straight)
            hand_on(straight, bucket)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    return order[wanted[order]]


def repeated_windows(pieces: list[bytes], span: int = SPAN) -> list[np.ndarray]:
    """For every piece, whether each of its windows is equal to another window of any piece."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    raw = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8)
    text = raw + np.uint8(1)  # no UTF-8 text holds 0xFF: only the ends of pieces become 0
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    windows = sizes - span + 1
    mark = np.zeros(len(text) + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + windows, -1)
    order = suffix_order(text, np.cumsum(mark[:-1]) > 0, span)
    words = _words(text, span)
    same = np.arange(len(order) - 1)  # pairs of neighbours whose common prefix may still reach the span
    for depth in [*range(0, span - 7, 8), span - 8]:
        same = same[words[order[same] + depth] == words[order[same + 1] + depth]]
    found = np.zeros(len(text), bool)
    found[order[same]] = True
    found[order[same + 1]] = True
    return [found[a : a + n] for a, n in zip(starts.tolist(), windows.tolist())]


def _runs(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return zip(edges[::2].tolist(), edges[1::2].tolist())


def merged(ranges: Iterable[tuple[int, int]]) -> list[list[int]]:
    """Sorted ranges with those that touch or overlap made one."""
    out: list[list[int]] = []
    for start, end in ranges:
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


RANGES = f"{ROW} long, start long, end long"


def _ranges(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=[ROW, "start", "end"])


def arrays(rows: Iterator[tuple], limit: int) -> Iterator[list[tuple]]:
    """(key, bytes of the key, ...) rows, sorted by key, in lists of whole keys of at most ``limit`` bytes together."""
    held, size, last = [], 0, None
    for row in rows:
        if row[0] != last:
            if held and size + row[1] > limit:
                yield held
                held, size = [], 0
            size += row[1]
            last = row[0]
        held.append(row)
    if held:
        yield held


PIECE = f"key long, bytes long, {ROW} long, start long, members long, piece binary"
PIECE_COLUMNS = ["key", "bytes", ROW, "start", "members", "piece"]


def array_ranges(pieces: DataFrame, limit: int) -> DataFrame:
    """(_row, start, end) of repeated windows among PIECE rows, by suffix arrays of whole keys."""

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(batch.column(i).to_pylist() for i in range(6))))
        for held in arrays(rows, limit):
            found = [
                (row, start + a, start + b - 1 + SPAN)
                for (_, _, row, start, members, _), mask in zip(held, repeated_windows([h[5] for h in held]))
                if members == 1  # classes with more members are repeated as a whole
                for a, b in _runs(mask)
            ]
            if found:
                yield _ranges(found)

    return pieces.select(*PIECE_COLUMNS).repartition("key").sortWithinPartitions("key").mapInArrow(sort, RANGES)


def finer_runs(least: int, key: int, piece: bytes, depth: int) -> Iterator[tuple[int, int, int]]:
    """(start, windows, finer key) of the runs of a piece whose windows have ``key``, and ``least`` as their least hash.

    A window's string is the first in it with this hash.  Windows with ``depth``
    bytes before the string take these, the others those after it.  With no
    depth every window is a run.
    """
    n = len(piece) - SPAN + 1
    if not depth:
        yield from ((s, 1, key) for s in range(n))
        return
    last = -1
    for p in np.flatnonzero(gram_hashes(piece).view(np.int64) == least).tolist():
        first, last = last + 1, p
        middle = min(max(first, p - depth + 1), n)
        for side, a, b, beside in ((b"<", first, middle, piece[p - depth : p] if p >= depth else b""), (b">", middle, min(p + 1, n), piece[p + GRAM : p + GRAM + depth])):
            if a < b:
                yield a, b - a, xxhash.xxh3_64_intdigest(key.to_bytes(8, "little", signed=True) + side + beside) - (1 << 63)
        if p >= n:
            break


def split_keys(pieces: DataFrame, depth: int) -> DataFrame:
    """The runs of PIECE rows with finer keys: a row for all equal runs of a piece.

    ``members`` counts the places of a run's bytes that its piece stands for.  Runs
    that a piece holds twice are repeated whatever other pieces hold: for a piece
    that stands for one place, ``repeats`` of its first row lists their merged byte
    ranges, at most one for SPAN bytes however short the period.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, row, start, members, piece, least in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4, 5, 6))):
                runs: dict[tuple, list[tuple[int, int]]] = {}
                for s, n, finer in finer_runs(least, key, piece, depth):
                    runs.setdefault((finer, *digest(piece[s : s + n - 1 + SPAN])), []).append((s, n))
                out = [
                    (finer, row, start + at[0][0], at[0][1], members * len(at), d1, d2, least, piece[at[0][0] : at[0][0] + at[0][1] - 1 + SPAN])
                    for (finer, d1, d2), at in runs.items()
                ]
                twice = [(start + s, start + s + n - 1 + SPAN) for at in runs.values() if members == 1 and len(at) > 1 for s, n in at]
                columns = [*zip(*out), [merged(sorted(twice)), *[[]] * (len(out) - 1)]]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in columns[:8]], pa.array(columns[8], pa.binary()), pa.array(columns[9], pa.list_(pa.list_(pa.int64())))],
                    names=["key", ROW, "start", "windows", "members", *DIGEST, "least", "piece", "repeats"],
                )

    return pieces.select(*PIECE_COLUMNS, "least").mapInArrow(
        cut, f"key long, {ROW} long, start long, windows long, members long, digest long, digest2 long, "
        "least long, piece binary, repeats array<array<long>>",
    )


def split_ranges(pieces: DataFrame, limit: int, depths: tuple[int, ...] = DEPTHS) -> DataFrame:
    """(_row, start, end) of repeated windows among PIECE rows whose keys are too large for one array."""
    found, pieces = None, pieces.withColumn("least", F.col("key"))
    for depth in (*depths, 0):
        runs = written(split_keys(pieces, depth), "runs", compression="zstd")
        size = F.col("windows") - 1 + SPAN
        # the bytes of a class and its least hash are those of any member
        classes = runs.groupBy("key", *DIGEST).agg(
            F.sum("members").alias("members"), F.min(F.struct(ROW, "start")).alias("at"),
            *[F.first(c).alias(c) for c in ("windows", "least", "piece")],
        )
        classes = written(classes.select("key", *DIGEST, "members", "at.*", "windows", "least", "piece"), "classes", compression="zstd")
        more = runs.filter("members = 1").join(classes.filter("members > 1").select("key", *DIGEST), ["key", *DIGEST])
        here = more.select(ROW, "start", (F.col("start") + size).alias("end"))
        repeats = runs.select(ROW, F.explode("repeats").alias("at"))
        here = here.unionByName(repeats.select(ROW, F.col("at")[0].alias("start"), F.col("at")[1].alias("end")))
        found = here if found is None else found.unionByName(here)
        if not depth:  # single windows: their classes say all
            return found
        kinds = classes.groupBy("key").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("classes")).filter("classes > 1")
        kinds = written(kinds.select("key", "bytes"), "kinds")
        large = F.col("bytes") > limit
        pieces = classes.join(kinds.filter(~large), "key").select(*PIECE_COLUMNS)
        found = found.unionByName(array_ranges(pieces, limit))
        if kinds.filter(large).isEmpty():
            return found
        pieces = classes.join(kinds.filter(large), "key").select(*PIECE_COLUMNS, "least")
    return found


# ------------------------------------------------------------ Spark operators


def repeated_ranges(docs: DataFrame, limit: int | None = None) -> DataFrame:
    """(_row, start, end): byte ranges of repeated windows of every (_row, data) text; they may overlap."""
    ship(docs.sparkSession)
    limit = ARRAY_BYTES if limit is None else limit
    rows = segment_rows(docs)
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("own"))
    shared = shared.filter("n > 1 or own > 0").select("key")
    shared = written(rows.join(shared, "key"), "segments")
    classes = shared.groupBy("key", *DIGEST).agg(
        F.count(F.lit(1)).alias("members"), F.min(F.struct(ROW, "start")).alias("at"), F.first("windows").alias("windows"),
        F.max("own").alias("own"),
    )
    classes = written(classes.select("key", *DIGEST, "members", "at.*", "windows", "own"), "classes")
    whole = shared.join(classes.filter("members > 1").select("key", *DIGEST), ["key", *DIGEST]).select(
        ROW, "start", (F.col("start") + F.col("windows") - 1 + SPAN).alias("end")
    )
    kinds = classes.groupBy("key").agg(
        F.count(F.lit(1)).alias("classes"), F.max("own").alias("o"), F.sum(F.col("windows") - 1 + SPAN).alias("bytes")
    )
    kinds = written(kinds.filter("classes > 1 or o > 0").select("key", "bytes"), "kinds")  # so that a key's classes can be joined in several tasks
    wanted = classes.join(kinds, "key").groupBy(ROW, (F.col("bytes") > limit).alias("large")).agg(
        F.collect_list(F.struct("key", "bytes", "start", "members", "windows")).alias("wanted")
    )
    wanted = written(wanted, "wanted")
    found = whole.unionByName(array_ranges(_pieces(docs, wanted.filter("not large")), limit))
    large = wanted.filter("large")
    return found if large.isEmpty() else found.unionByName(split_ranges(_pieces(docs, large), limit))


def _pieces(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The classes that a text is ``wanted`` for, with the bytes of their first member."""

    def slice_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, wanted in zip(*(batch.column(i).to_pylist() for i in range(3))):
                out = [(w["key"], w["bytes"], row, w["start"], w["members"], data[w["start"] : w["start"] + w["windows"] + SPAN - 1]) for w in wanted]
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, pa.int64()) for c in columns[:5]], pa.array(columns[5], pa.binary())], names=PIECE_COLUMNS
                )

    ids = wanted.select(ROW)
    small = ids.count() <= BROADCAST_ROWS
    texts = docs.select(ROW, "data").join(F.broadcast(ids) if small else ids, ROW, "left_semi")
    return texts.join(wanted, ROW).select(ROW, "data", "wanted").mapInArrow(slice_, PIECE)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, doc_id, n_bytes, n_removed, n_spans, kept) of every row; ``kept``: the bytes that remain."""
    data = stored(keyed(docs, id_col, text_col)).select(ROW, "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    ranges = repeated_ranges(data).groupBy(ROW).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("ranges")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out = []
                for text, ranges in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    spans = merged((r["start"], r["end"]) for r in ranges or ())
                    edges = [0, *[e for s in spans for e in s], len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
                    out.append((len(text), len(text) - len(kept), len(spans), kept))
                *numbers, kept = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *[pa.array(c, pa.int64()) for c in numbers], pa.array(kept, pa.binary())],
                    names=[ROW, "doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return data.join(ranges, ROW, "left").select(ROW, "doc_id", "data", "ranges").mapInArrow(
        cut, f"{ROW} long, doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    )


def query(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
