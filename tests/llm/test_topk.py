import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from mobility.llm import topk
from tests.llm.brute import SF, as_rows, duck, same, table

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
        *[T.StructField(c, T.StringType()) for c in ("_row", "vector", "block", "score", "a.b")],
    ]
)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, *["x"] * 5) for i, v in rows], SCHEMA)


def brute(rows, k=topk.TOP):
    """Every query row's best by Python's own integers."""
    used = []
    for i, v in rows:
        if v is not None and all(x is not None and np.isfinite(x) and np.isfinite(x * 256) for x in v):
            used.append((i, [int(np.floor(256 * x)) for x in v]))
    out = []
    for a, (query, q) in enumerate(used):
        if query is None or query % topk.QUERY_EVERY:
            continue
        scored = []
        for b, (i, v) in enumerate(used):
            if a != b:
                score = min(max(sum(x * y for x, y in zip(q, v)), -(1 << 63)), (1 << 63) - 1)
                scored.append((-score, i is None, i or 0))
        out += [(query, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()), key=repr)


def test_matches_sql(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = duck(topk.ORACLE, embeddings=table(SF, "embeddings"))
    got = as_rows(topk.query(df))
    assert got == same(want) and len(got) == 5 * df.filter("vec_id % 50 = 0").count()


@pytest.mark.parametrize("block", [3, 8192])
def test_edge_rows(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, -0.5]), (0, [1.0, 0.0, -0.5]),  # one row twice: each finds the other
        (50, [0.001, 0.5]), (-50, [0.0, 0.0, 0.0, 2.0]), (100, []), (150, None), (200, [1.0, None]), (250, [nan]),
        (300, [inf, 1.0]), (None, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (1, [0.25, 0.25]), (2, [0.25, 0.25]),
        (3, [0.25, 0.25]), (4, [0.25, 0.25]), (5, [0.25, 0.25]), (6, [0.25, 0.25]), (7, [-0.25, 0.25, 9.0]),
    ]
    assert found(topk.query(vectors(spark, rows))) == brute(rows)
    assert topk.query(vectors(spark, [])).collect() == []
    assert topk.query(vectors(spark, [(1, [1.0])])).collect() == []
    assert topk.query(vectors(spark, [(50, [1.0])])).collect() == []  # no other row


@pytest.mark.parametrize("size", [1e5, 1e12, 1e20, 1e300])
def test_large_numbers_stay_exact(spark, size):
    rng = random.Random(3)
    rows = [(i * 25, [rng.uniform(-size, size) for _ in range(4)]) for i in range(30)] + [(3, [1.7e308]), (50, [1e306] * 3)]
    assert found(topk.query(vectors(spark, rows))) == brute(rows)


def test_sparse_and_long_vectors_in_many_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BYTES", 4000)  # several blocks of queries
    monkeypatch.setattr(topk, "TASK_WORK", 1000)  # and candidates dealt out anew
    rng = random.Random(5)
    rows = [(i, [rng.choice([0.0] * 6 + [0.25, -1.0, 3.5]) for _ in range(rng.randint(1, 60))]) for i in range(600)]
    assert found(topk.query(vectors(spark, rows))) == brute(rows)
    assert len(found(topk.search(vectors(spark, rows), k=2))) == 2 * 12


def test_postings_leave_zeros_out():
    values = topk.quantised(np.array([0.0, 1.0, 0.003, 0.0, 0.0, -1.0]))
    postings = topk.Postings(values, np.array([2, 0, 2, 1, 1]))
    lists = postings.of("i8")
    assert sorted(lists) == [0, 1] or sorted(lists) == [0, 1, 2]
    assert postings.scores([1], [2]).tolist() == [512, 0, 0, 0, 0]
    assert postings.scores([0, 7], [3, 9]).tolist() == [0, 0, 0, 0, -768]
    assert topk.sparse_rows(pa.array([[0.0, 1.0], [], [-0.001]])) == [([1], [256]), ([], []), ([0], [-1])]
