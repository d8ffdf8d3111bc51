"""Plain, slow versions of what the operators compute, and a table of awkward rows."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter, defaultdict

import duckdb
import pyarrow.parquet as pq
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

PROSE = (
    "The house by the river was old and the people of the town had not been in it for years. "
    "On that day they came with a lamp and a book, and one of them said that he would read to the others "
    "what his father had written there. It was late when the reading was over and nobody wanted to go."
)

#: Extra columns whose names clash with names that the operators use inside.
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(c, T.StringType()) for c in ("_row", "_doc", "words", "key", "data", "label", "a.b")],
    ]
)

LONG = " ".join(f"{PROSE} {i}" for i in range(3000))  # about a megabyte

EDGE_TEXTS = [
    (1, PROSE),
    (1, PROSE),  # the whole row again
    (2, PROSE + " So they stayed until the morning."),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "one two"),
    (7, "one two"),
    (None, "text without an id: token = abcdef0123456789abcdef0123456789"),
    (8, LONG),
    (9, "a" * 3000),
    (10, "héllo wörld 你好 " * 30),
    (11, "mail a.b@c.example.org, +1 (017) 555-7713, 10.0.0.1"),
]


#: The same without the long text, for SQL that is quadratic in a text's words.
SHORT_TEXTS = [r for r in EDGE_TEXTS if r[0] != 8]


def edge_docs(spark, texts=EDGE_TEXTS):
    rows = [
        (i, t, None if i == 6 else "en", None if i == 7 else f"src{(i or 0) % 3}", None if t is None else len(t), *["x"] * 7)
        for i, t in texts
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf=SF):
    return spark.read.parquet(f"{sf}/documents.parquet")


def duck(sql: str, **views):
    con = duckdb.connect()
    for name, frame in views.items():
        con.register(name, frame)
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return [dict(zip(names, row)) for row in cursor.fetchall()]


def table(sf: str, name: str):
    return pq.read_table(f"{sf}/{name}.parquet")


def as_rows(df, drop=()):
    return sorted((tuple((k, v) for k, v in sorted(r.asDict().items()) if k not in drop) for r in df.collect()), key=repr)


def same(rows, drop=()):
    return sorted((tuple((k, v) for k, v in sorted(r.items()) if k not in drop) for r in rows), key=repr)


# ------------------------------------------------------------------ similarity


def shingle_set(text, size=4):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(zip(*[words[i:] for i in range(size)]))


def components_of(edges, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def similar(texts, percent=85, size=4):
    """Component of every key of ``texts``, all pairs that share a shingle being compared."""
    sets = {i: shingle_set(t, size) for i, t in texts.items()}
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    pairs = {p for ids in where.values() for p in itertools.combinations(sorted(ids), 2)}
    links = []
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            links.append((a, b))
    return components_of(links, sets)


# ------------------------------------------------------------------- repetition


def repeated(texts, span=200):
    """(n_bytes, n_removed, n_spans, kept digest) of every text."""
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + span] for b in data for i in range(len(b) - span + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - span + 1):
            if count[b[i : i + span]] > 1:
                gone[i : i + span] = b"\x01" * span
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = len(re.findall(b"\x01+", bytes(gone)))
        out.append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


# ---------------------------------------------------------------------- secrets

ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, a, b) for a, _, b, k in sorted(out)]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
