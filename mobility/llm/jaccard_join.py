"""N-gram Jaccard join by grouped prefixes.

A document is its set of distinct word shingles (four words unless told otherwise).  All shingles are ordered
from rare to frequent; two sets with a Jaccard similarity of at least the
threshold share a shingle within their short prefixes of that order, at places
that leave enough shingles behind to reach the threshold.  Documents with the
same prefix and size form one group, and equal sets within it one class, so
that copies are joined once.  Groups that share a prefix shingle are filtered
by size and place; the survivors are expanded to their classes and verified on
the whole sets.

The rare-to-frequent order comes from a count of all documents' shingles in a
fixed number of buckets.  Any order gives the same result; this one keeps
frequent passages out of the prefixes at every corpus size.

Only components are asked for, so a shingle's groups are first joined as a
star around the group that has it earliest.  Verified links are contracted, and
then every pair whose members are still in different components is joined
and verified: no link between different texts is lost, and a large group of
near copies costs its size, not its square.

Shingles are compared as 64-bit hashes, classes by 128-bit digests of whole
sets.  Defined cases: a null text, or one without words, has the empty set and
is linked with nothing (its component is its own id); a text of fewer
words than a shingle is one shingle; repeated rows are members of one class; null ids
are ignored by the least id unless there is no other; texts of any length are
read whole; ties in the order of shingles go by hash; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import BROADCAST_MAX_BYTES, DOC, ROW, keyed, name, rows, ship, stored, whole, written
from mobility.llm.components import components

#: Link if 100 * intersection >= PERCENT * union.
PERCENT = 85
SHINGLE = 4
#: Buckets of the shingle counts that give the order (a power of two), and their blocks.
BUCKETS = 1 << 20
BLOCK = 1 << 14
#: Rows that are sent to all executors, 8 bytes each.
BROADCAST_ROWS = BROADCAST_MAX_BYTES // 64
#: Words whose hash a worker keeps.
CACHED_WORDS = 500_000

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _Words()


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of the text's word shingles (A-Z lower-cased, ASCII white space)."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    n = min(size, len(h))
    out = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        out ^= out >> np.uint64(31)
        out *= _M1
        out += h[k : len(h) - n + 1 + k]
    out ^= out >> np.uint64(30)
    out *= _M2
    out ^= out >> np.uint64(27)
    if n < size:
        out ^= np.uint64(n)  # a short sequence is no longer text's shingle
    return np.unique(out)


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """Shingles of the prefix of a set of n: two linked sets share one of them."""
    return n - -(-percent * n // 100) + 1


def _links(overlap, n, m, percent: int = PERCENT):
    """100 * overlap >= percent * union, in integers; for numbers and columns alike."""
    return (100 + percent) * overlap >= percent * (n + m)


def bucket_counts(texts: DataFrame, shingle: int = SHINGLE) -> np.ndarray:
    """Documents per shingle bucket over all of ``texts``: of fixed size, summed by block in Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            found = [_bucket(shingles(t, shingle)) for t in batch.column(0).to_pylist()]
            for at in range(0, len(found), 1000):
                total += np.bincount(np.concatenate(found[at : at + 1000]), minlength=BUCKETS)
        if total.any():
            blocks = [zlib.compress(b.tobytes(), 1) for b in total.astype("<i8").reshape(-1, BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int64()), pa.array(blocks, pa.binary())], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[block] = sums.get(block, 0) + np.frombuffer(zlib.decompress(data), "<i8")
        for block, counts in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([counts.tobytes()], pa.binary())], names=["block", "counts"])

    ship(texts.sparkSession)
    kind = "block long, counts binary"
    total = np.zeros((BUCKETS // BLOCK, BLOCK), np.int64)
    for r in texts.mapInArrow(count, kind).repartition("block").mapInArrow(add, kind).toLocalIterator():
        total[r["block"]] = np.frombuffer(r["counts"], "<i8")
    return np.argsort(np.argsort(total.ravel(), kind="stable"), kind="stable").astype(np.int32)


def signatures(docs: DataFrame, order: np.ndarray, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(_row, doc_id, n, cls, grp, prefix) of every ``keyed`` document: set size, digests of the set and of size and prefix."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out = []
                for text in part.column(2).to_pylist():
                    found = shingles(text, shingle)
                    n = len(found)
                    rare = np.argsort(order[_bucket(found)].astype(np.int64), kind="stable")  # equal buckets: by hash
                    prefix = found[rare[: prefix_size(n, percent)]] if n else found
                    group = xxhash.xxh3_128_digest(n.to_bytes(8, "little") + prefix.tobytes())
                    out.append((n, xxhash.xxh3_128_digest(found.tobytes()), group, prefix.view(np.int64)))
                n, cls, grp, prefix = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.binary()),
                     pa.array(grp, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))],
                    names=[ROW, "doc_id", "n", "cls", "grp", "prefix"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(sign, f"{ROW} long, doc_id {kind}, n long, cls binary, grp binary, prefix array<long>")


def classes_of(signed: DataFrame) -> DataFrame:
    """(cls, c, d, n, g): a class of equal sets, its first row and least id, its size, and its group's first class."""
    classes = signed.filter("n > 0").groupBy("cls").agg(
        F.min(ROW).alias("c"), F.min("doc_id").alias("d"), F.first("n").alias("n"), F.first("grp").alias("grp")
    )
    groups = classes.groupBy("grp").agg(F.min("c").alias("g"))
    return classes.join(groups, "grp").drop("grp")


def prefix_lists(signed: DataFrame) -> DataFrame:
    """(token, g, n, pos): the groups of every prefix shingle that at least two groups have.

    Size and place travel as one number: this is the widest shuffle.
    """
    groups = signed.filter("n > 0").groupBy("grp").agg(
        F.min(ROW).alias("g"), F.first("n").alias("n"), F.first("prefix").alias("prefix")
    )
    entries = groups.select("g", "n", F.posexplode("prefix").alias("pos", "token")).select(
        "token", "g", F.shiftleft("n", 31).bitwiseOR(F.col("pos").cast("long")).alias("at")
    )
    shared = entries.groupBy("token").agg(F.count(F.lit(1)).alias("groups")).filter("groups > 1").select("token")
    n, pos = F.shiftright("at", 31), F.col("at").bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
    return entries.join(shared, "token").select("token", "g", n.alias("n"), pos.alias("pos"))


def _can_link(a: str, b: str, percent: int, known: Column | int = 0) -> Column:
    """Size and place filter: if this is their first common shingle after ``known`` ones, what is behind it must suffice.

    Linked sets pass it at the first shingle that they share.
    """
    behind = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    return _links(behind + known, F.col(f"{a}.n"), F.col(f"{b}.n"), percent)


def star_pairs(lists: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b) classes: every list's earliest group with each other group's classes, and each group's first class with its others."""
    hubs = lists.groupBy("token").agg(F.min(F.struct("pos", "n", "g")).alias("h")).select("token", "h.*")
    met = (
        hubs.alias("x").join(lists.alias("y"), "token")
        .filter((F.col("x.g") != F.col("y.g")) & _can_link("x", "y", percent))
        .select(F.col("x.g").alias("a"), F.col("y.g").alias("g")).distinct()
    )
    between = met.join(classes.select("g", F.col("c").alias("b")), "g").select("a", "b")
    within = classes.filter("c != g").select(F.col("g").alias("a"), F.col("c").alias("b"))
    return between.unionByName(within).distinct()


#: Pairs of a list that is joined with itself as it is; those of more are cut by a further common shingle.
LIST_PAIRS = 1 << 20
#: Further shingles by which a list is cut at most: each gives an entry for all places where it may be.
LEVELS = 2


def open_lists(entries: DataFrame) -> DataFrame:
    """The entries of lists with several components, written.

    With the list's commonest component, its entries outside of that, the pairs
    to be looked at (of these with all entries) and the largest n.
    """
    sizes = entries.groupBy("token", "label").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("most_n"))
    commonest = sizes.groupBy("token").agg(
        F.max(F.struct("k", "label")).alias("most"), F.count(F.lit(1)).alias("labels"), F.sum("k").alias("size"),
        F.max("most_n").alias("most_n"),
    ).filter("labels > 1").select(
        "token", F.col("most.label").alias("common"), (F.col("size") - F.col("most.k")).alias("others"), "size", "most_n"
    ).withColumn("pairs", F.col("others") * F.col("size")).drop("size")
    return written(entries.join(commonest, "token"), "mixed")


ENTRY = ["token", "c", "n", "label", "pos", "known"]


def finer_lists(entries: DataFrame, docs: DataFrame, order: np.ndarray, percent: int, shingle: int) -> DataFrame:
    """The entries again, once for each shingle that can be the next common one, under the two together.

    A set of n that has ``known`` + 1 shingles of a link up to place ``pos``
    needs percent of n in all, so the next one is among as many places behind
    as it can do without; a set that needs no more gives all its places, for
    the partners that do.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, asked in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = shingles(text, shingle)
                n = len(found)
                rare = found[np.argsort(order[_bucket(found)].astype(np.int64), kind="stable")]
                tokens, places, at = [], [], []
                for i, e in enumerate(asked):
                    first = e["pos"] + 1
                    needed = max(-(-percent * n // 100) - e["known"] - 1, 1)
                    last = n - needed + 1
                    here = rare[first:last]
                    seed = np.uint64(e["token"] & 0xFFFFFFFFFFFFFFFF)
                    mixed = (here ^ (seed >> np.uint64(29))) * _M1 + seed
                    tokens.append(((mixed ^ (mixed >> np.uint64(32))) * _M2).view(np.int64))
                    places.append(np.arange(first, first + len(here)))
                    at += [i] * len(here)
                if at:
                    some = {k: [asked[i][k] for i in at] for k in ("n", "label", "known")}
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(tokens)), pa.array([row] * len(at), pa.int64()), pa.array(some["n"], pa.int64()),
                         pa.array(some["label"], pa.int64()), pa.array(np.concatenate(places), pa.int32()),
                         pa.array([k + 1 for k in some["known"]], pa.int32())],
                        names=ENTRY,
                    )

    asked = written(entries.groupBy("c").agg(F.collect_list(F.struct("token", "n", "label", "pos", "known")).alias("asked")), "asked")
    ids = asked.select("c")
    small = ids.count() <= BROADCAST_ROWS  # else the texts are shuffled to them
    texts = docs.select(F.col(ROW).alias("c"), "text").join(F.broadcast(ids) if small else ids, "c", "left_semi")
    return texts.join(asked, "c").select("c", "text", "asked").mapInArrow(cut, "token long, c long, n long, label long, pos int, known int")


def open_pairs(
    lists: DataFrame, classes: DataFrame, labels: DataFrame, docs: DataFrame, order: np.ndarray, percent: int = PERCENT, shingle: int = SHINGLE
) -> DataFrame:
    """(a, b): every pair of classes that can link and is not yet in one component.

    Of each list, the entries outside its commonest component meet all entries
    of other components; a list in one component costs nothing.  A list of more
    than LIST_PAIRS such pairs is first cut by the next shingle that linked members
    share, so that sets with a common passage and little else do not meet; what
    is still long after LEVELS such cuts is dealt out to several tasks.
    """
    labelled = classes.join(labels, classes["c"] == labels["node"], "left").select(
        "c", "g", "n", F.coalesce("component", "c").alias("label")
    )
    own = labelled.groupBy("g").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("g")
    within = own.select(F.xxhash64("g", F.lit("group")).alias("token"), "g", F.lit(None).cast("int").alias("pos"))
    whole_prefix = F.expr(f"cast(n - ({percent} * n + 99) div 100 as int)")  # place of its last shingle
    entries = lists.select("token", "g", "pos").unionByName(within).join(labelled, "g").select(
        "token", "c", "n", "label", F.coalesce("pos", whole_prefix).alias("pos"), F.when(F.col("pos").isNull(), whole_prefix).otherwise(0).alias("known")
    )
    state, done = open_lists(entries), []
    for _ in range(LEVELS):
        cut = (F.col("pairs") > LIST_PAIRS) & (50 * F.col("others") > (100 - percent) * F.col("most_n"))
        long = state.filter(cut).select(*ENTRY)
        if long.isEmpty():
            break
        done.append(state.filter(~cut))
        enough = long.filter(F.expr(f"({percent} * n + 99) div 100 <= known + 1"))  # may link by what is known
        state = open_lists(finer_lists(long, docs, order, percent, shingle).unionByName(enough))
    mixed = state
    for part in done:
        mixed = mixed.unionByName(part)
    mixed = mixed.withColumn("shares", F.ceil(F.col("pairs") / LIST_PAIRS))
    asked = mixed.filter("label != common").withColumn("share", F.pmod(F.xxhash64("c"), F.col("shares")))
    dealt = mixed.filter("shares > 1").withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)))
    met = mixed.filter("shares = 1").withColumn("share", F.lit(0).cast("long")).unionByName(dealt)
    pairs = (
        asked.alias("x")
        .join(met.alias("y"), ["token", "share"])
        .filter((F.col("x.label") != F.col("y.label")) & _can_link("x", "y", percent, F.least("x.known", "y.known")))
    )
    return pairs.select(F.least("x.c", "y.c").alias("a"), F.greatest("x.c", "y.c").alias("b")).distinct()


#: Members of a hub that one task's run compares with it.
HUB_SHARE = 512


def verified(pairs: DataFrame, docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """The (a, b) rows whose whole sets link.

    Every hub ``a`` is sent once for each share of its members, ahead of them,
    so a task keeps one set and compares the others as they stream by.
    """
    pairs = written(pairs, "pairs")
    shares = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / HUB_SHARE).alias("shares"))
    dealt = pairs.join(shares, "a").select("a", F.pmod(F.xxhash64("b"), F.col("shares")).alias("share"), "b")
    hubs = dealt.select("a", "share", F.lit(None).cast("long").alias("b")).distinct()
    wanted = written(hubs.unionByName(dealt).withColumn(ROW, F.coalesce("b", "a")), "wanted")
    small = wanted.count() <= BROADCAST_ROWS  # else the texts are shuffled to it
    texts = docs.select(ROW, "text").join(F.broadcast(wanted) if small else wanted, ROW).select("a", "share", "b", "text")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = None
        for batch in batches:
            a, b, text = (batch.column(i).to_pylist() for i in (0, 2, 3))
            linked = []
            for x, y, t in zip(a, b, text):
                found = shingles(t, shingle)
                if y is None:
                    hub = found
                else:
                    common = len(np.intersect1d(hub, found, assume_unique=True))
                    if _links(common, len(hub), len(found), percent):
                        linked.append((x, y))
            if linked:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*linked)], names=["u", "v"])

    streamed = texts.repartition("a", "share").sortWithinPartitions("a", "share", F.col("b").asc_nulls_first())
    return streamed.mapInArrow(compare, "u long, v long")


def joined(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(_row, doc_id, n_shingles, component_id, first) of every ``keyed`` document (``stored``: they are read several times).

    component_id is the least doc_id of the component; ``first`` is true for
    exactly one row of each (the first row that has this id), and for every
    document without shingles.
    """
    order = bucket_counts(docs.select("text"), shingle)
    signed = written(signatures(docs, order, percent, shingle), "signatures")
    classes = written(classes_of(signed), "classes")
    lists = written(prefix_lists(signed.select(ROW, "n", "grp", "prefix")), "lists")
    links = written(verified(star_pairs(lists, classes, percent), docs, percent, shingle), "links")
    still = written(open_pairs(lists, classes, components(links), docs, order, percent, shingle), "open")
    if not still.isEmpty():
        links = links.unionByName(written(verified(still, docs, percent, shingle), "links"))
    labels = components(links)
    found = classes.join(labels, classes["c"] == labels["node"], "left").select("cls", "d", F.coalesce("component", "c").alias("label"))
    least = found.groupBy("label").agg(F.min("d").alias("component_id"))
    named = found.select("cls", "label").join(least, "label")
    members = signed.select(ROW, "doc_id", "n", "cls").join(named, "cls", "left")
    keep = members.filter("n > 0").groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", ROW))[ROW].alias("_first"))
    return members.join(keep, "label", "left").select(
        ROW,
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        ((F.col("n") == 0) | (F.col(ROW) == F.col("_first"))).alias("first"),
    )


def query(docs: DataFrame) -> DataFrame:
    return joined(stored(keyed(docs))).select("doc_id", "n_shingles", "component_id")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, shingle: int = SHINGLE
) -> DataFrame:
    """The rows of ``docs``, all columns, without all but the first of every component."""
    every = stored(rows(docs))
    texts = every.select(ROW, name(id_col, DOC).alias("doc_id"), name(text_col, DOC).alias("text"))
    gone = joined(texts, percent, shingle).filter(~F.col("first")).select(ROW)
    return every.join(gone, ROW, "left_anti").select(*whole(docs))
