"""Exact top-k search by inner product: exhaustive accumulation, a term at a time.

Every component x of a vector becomes the integer floor(256 * x); a term is a
place in the vector, and zeros are not stored.  Each task turns a block of
candidates into posting lists (term: candidates and their values), and every
sparse query row scatters its weighted postings, a term after the other, into
a dense array of scores, one entry a candidate.  A partition selection keeps
the best of the block, and the bests of blocks and tasks are merged.  Nothing is
skipped or estimated.

The queries are cut into blocks of ``QUERY_BYTES`` by a hash of their row, and
one block at a time is sent to all tasks; each block's result is written before
the next, so a lost executor costs some tasks of one block.  A task holds one
block of queries and of candidates, at any size of the tables.

Defined cases: vectors that are null or hold a null or non-finite component
(after scaling) take no part; an empty vector scores 0; of vectors of unequal
length the missing components count as 0; a candidate with a null id comes
after all others of its score, a null id is no query; rows with equal ids are
queries and candidates each on their own, and a query is left out of its own
candidates by row, so a copy of it is found; ties go to the smaller id; scores
beyond 64 bits are reported as the nearest 64-bit number; an empty table gives
an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobility.llm.common import ROW, name, shared_dir, ship, written

#: Fixed values of the search.
SCALE = 256
TOP = 5
QUERY_EVERY = 50
#: Candidates whose postings and scores are held at once.
BLOCK = 8192
#: Bytes of query vectors (as 64-bit numbers) that are sent to the tasks at once.
QUERY_BYTES = 16 << 20
#: Multiplications of a task, in expectation, once there are more than all cores can share.
TASK_WORK = 200_000_000_000

_NARROW = 1 << 31  # scores below fit 32 bits
_WIDE = 1 << 49  # scores below fit 64 bits together with a place in a block


def usable(vector: Column) -> Column:
    """Whether every component is a finite number, also after scaling."""
    inf = F.lit(float("inf"))
    return vector.isNotNull() & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * SCALE < inf)
    )


def quantised(values: np.ndarray) -> np.ndarray:
    """floor(256 * x): 64-bit integers, or Python's where one does not fit."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    if not len(scaled) or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    return np.array([int(x) for x in scaled], object)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, sizes) of a list column without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    return quantised(column.flatten().to_numpy(zero_copy_only=False)), sizes


def sparse_rows(column: pa.Array) -> list[tuple[list[int], list[int]]]:
    """(terms, weights) of every vector, zeros left out."""
    values, sizes = _flat(column)
    out, at = [], 0
    for n in sizes.tolist():
        row = values[at : at + n]
        terms = np.flatnonzero(row)
        out.append((terms.tolist(), row[terms].tolist()))
        at += n
    return out


class Postings:
    """The posting lists of a block of candidates, which are in the order of their ids."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray):
        self.n = len(sizes)
        self.widest = int(sizes.max()) if self.n else 0
        self.largest = int(np.abs(values).max()) if len(values) else 0
        self.values, self.sizes = values, sizes
        self.lists: dict[str, dict[int, tuple[np.ndarray | None, np.ndarray]]] = {}

    def of(self, kind) -> dict[int, tuple[np.ndarray | None, np.ndarray]]:
        """term: (candidates, values); a list that holds most candidates is kept as a whole row, with None."""
        if kind not in self.lists:
            starts = np.cumsum(self.sizes) - self.sizes
            term = np.arange(len(self.values)) - np.repeat(starts, self.sizes)
            some = np.flatnonzero(self.values)
            some = some[np.argsort(term[some], kind="stable")]
            candidate = np.repeat(np.arange(self.n), self.sizes)[some]
            values, term = self.values[some].astype(kind), term[some]
            edges = np.concatenate([[0], np.flatnonzero(term[1:] != term[:-1]) + 1, [len(term)]])
            out = {}
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()) if len(term) else ():
                if 2 * (b - a) >= self.n:
                    row = np.zeros(self.n, kind)
                    row[candidate[a:b]] = values[a:b]
                    out[int(term[a])] = (None, row)
                else:
                    out[int(term[a])] = (candidate[a:b], values[a:b])
            self.lists[kind] = out
        return self.lists[kind]

    def scores(self, terms: list[int], weights: list[int]) -> np.ndarray:
        """The dense scores of one sparse query row, exact (clipped to 64 bits)."""
        bound = max(map(abs, weights), default=0) * self.largest * min(len(terms), self.widest)
        kind = "i4" if bound < _NARROW else "i8" if bound < _WIDE else "O"
        postings = self.of(kind)
        scores, product = np.zeros(self.n, kind), np.empty(self.n, kind)
        for term, weight in zip(terms, weights):
            candidates, values = postings.get(term, (None, None))
            if values is None:
                continue
            if candidates is None:
                np.multiply(values, weight, out=product)
                scores += product
            else:
                scores[candidates] += values * weight
        if kind == "O":
            scores = np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in scores], np.int64)
        return scores


def best_of(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` of ``places`` with the highest scores, ties to the smaller place, best first."""
    found = scores[places].astype(np.int64)
    if not len(found) or max(int(found.max()), -int(found.min())) >= _WIDE:
        return places[np.lexsort((places, ~found))[:k]]  # ~x falls as x grows, without overflow
    n = len(scores)
    key = found * n + (n - 1 - places)
    if len(key) > k:
        some = np.argpartition(key, len(key) - k)[len(key) - k :]
        places, key = places[some], key[some]
    return places[np.argsort(-key)]


PARTIAL = "query_row long, query_id long, vec_id long, score long"


def partial_bests(candidates: DataFrame, queries: pa.Table, k: int = TOP) -> DataFrame:
    """Each task's ``k`` best of its candidates for every query of one block."""
    sent = candidates.sparkSession.sparkContext.broadcast(
        list(zip(queries.column(ROW).to_pylist(), queries.column("vec_id").to_pylist(), sparse_rows(queries.column("vector"))))
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = sent.value
        held: list[list[tuple]] = [[] for _ in asked]  # (-score, id is null, id) of the best so far
        for batch in blocks(batches):
            ids = batch.column("vec_id").to_pylist()
            values, sizes = _flat(batch.column("vector"))
            postings = Postings(values, sizes)
            place = {r: i for i, r in enumerate(batch.column(ROW).to_pylist())}
            for best, (row, _, (terms, weights)) in zip(held, asked):
                scores = postings.scores(terms, weights)
                places = np.flatnonzero(scores >= -best[-1][0]) if len(best) == k else np.arange(len(scores))
                if row in place:
                    places = places[places != place[row]]
                if len(places):
                    best += [(-int(scores[i]), ids[i] is None, ids[i] or 0) for i in best_of(scores, places, k).tolist()]
                    best.sort()
                    del best[k:]
        for at in range(0, len(asked), 4096):
            found = [
                (row, query, None if null else vec_id, -score)
                for best, (row, query, _) in zip(held[at : at + 4096], asked[at : at + 4096])
                for score, null, vec_id in best
            ]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*found)], names=["query_row", "query_id", "vec_id", "score"]
                )

    return candidates.mapInArrow(search, PARTIAL)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The batches in tables of at most BLOCK rows, each in the order of its ids, nulls last."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield pa.Table.from_batches([batch.slice(at, BLOCK)]).sort_by("vec_id").combine_chunks()


def search(
    vectors: DataFrame, is_query: Column | None = None, k: int = TOP, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows for every row that ``is_query`` (of vec_id) selects."""
    spark = vectors.sparkSession
    ship(spark)
    is_query = F.col("vec_id") % QUERY_EVERY == 0 if is_query is None else is_query
    used = vectors.select(
        F.monotonically_increasing_id().alias(ROW),
        name(id_col).cast("long").alias("vec_id"),
        name(vector_col).alias("vector"),
    ).filter(usable(F.col("vector")))
    cores = int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = written(used.repartition(cores, ROW), "vectors", compression="zstd")
    size = F.sum(F.size("vector").cast("double"))
    all_, asked = every.agg(size).first()[0] or 0, every.filter(is_query).agg(size, F.count(F.lit(1))).first()
    n_blocks = int(((asked[0] or 0) * 8 + asked[1] * 64) // QUERY_BYTES) + 1
    tasks = int(all_ * asked[1] / n_blocks // TASK_WORK)
    queries = every.filter(is_query).withColumn("block", F.pmod(F.xxhash64(ROW), F.lit(n_blocks)))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    folder, paths = shared_dir(spark) + "/top", []
    for block in range(n_blocks):
        part = queries.filter(F.col("block") == block).select(ROW, "vec_id", "vector").toArrow()
        found = partial_bests(every.repartition(tasks, ROW) if tasks > cores else every, part, k)
        top = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        paths.append(f"{folder}/{block}")
        top.select("query_id", "rank", "vec_id", "score").write.parquet(paths[-1])
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(*paths)


def query(vectors: DataFrame) -> DataFrame:
    return search(vectors)


ORACLE = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id,
         coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % {QUERY_EVERY} = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}
"""
