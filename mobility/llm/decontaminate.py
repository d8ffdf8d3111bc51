"""Benchmark decontamination by winnowing, on native functions only.

Both sides hash every K-word gram; of each WINDOW consecutive grams the least
hash is kept (the rightmost of equal ones), so two texts that share a span of
K + WINDOW - 1 words keep at least one gram in common: no shared benchmark
window can be missed.  The kept grams ("fingerprints") are joined, and every
hit is extended to the whole benchmark window and compared word by word, so
nothing is reported by hash alone.

The guarantee length is the shortest window among the items (13 words, less
where an item is shorter).  Fingerprints of the items are broadcast when the
items' measured size bounds them.  Beyond the bound a table of bits, one for
each hash of an item (BITS_PER_HASH a hash, at most MOST_BITS), is broadcast
instead: fingerprints whose bit is not set end in the scan, and only the others
are shuffled, with the words around them, to the same join.

Defined cases: null or empty texts have no words (n_hit 0, contaminated false;
items without words have no window); texts of any length are read whole;
repeated rows are judged each on its own; of equal hashes in a window of grams
the rightmost is kept; items with equal windows are all reported, items with a
null id hit but are not listed; an empty benchmark hits nothing; extra columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import BROADCAST_MAX_BYTES, DOC, ROW, keyed, let, name, rows, stored, whole, written

#: Fixed values of the contamination rule.
WINDOW_WORDS = 13
MIN_HIT_SHARE = 20
#: Words of a hashed gram (fewer where the guarantee length is shorter).
GRAM_WORDS = 5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Bits of the table for a hash of the items, and its most bits (16 MB of them).
BITS_PER_HASH = 64
MOST_BITS = 1 << 27
#: Bits of a row of the table: 512 longs.
_ROW_BITS = 15

#: A fingerprint is one long: 33 hash bits above 30 position bits.  A text has
#: fewer than 2^30 words, and the low bits count down, so that the least code
#: is the least hash and of equal hashes the rightmost.
_POSITION_BITS = 30
_POSITION = (1 << _POSITION_BITS) - 1
_HASH = (1 << 33) - 1


def words_of(text: Column) -> Column:
    """Words after lower-casing A-Z only."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS), "")


def _gram(guarantee: int) -> int:
    return min(GRAM_WORDS, guarantee)


def _codes(words: Column, guarantee: int) -> Column:
    """The code of every gram of ``words`` (which has at least ``guarantee``)."""
    k = _gram(guarantee)

    def code(i: Column) -> Column:
        hashed = F.xxhash64(*[words[i + j] for j in range(k)]).bitwiseAND(F.lit(_HASH))
        return F.shiftleft(hashed, _POSITION_BITS).bitwiseOR(F.lit(_POSITION) - i)

    return F.transform(F.sequence(F.lit(0), F.size(words) - k), code)


def fingerprints(words: Column, guarantee: int) -> Column:
    """The distinct kept codes of ``words``; empty if it is shorter than the guarantee."""
    window = guarantee - _gram(guarantee) + 1

    def kept(codes: Column) -> Column:
        if window == 1:
            return codes
        starts = F.sequence(F.lit(1), F.size(codes) - (window - 1))
        return F.array_distinct(F.transform(starts, lambda i: F.array_min(F.slice(codes, i, window))))

    found = let(words, lambda w: let(_codes(w, guarantee), kept))
    return F.when(F.size(words) >= guarantee, found).otherwise(F.array().cast("array<bigint>"))


def _hash(code: Column) -> Column:
    return F.shiftright(code, _POSITION_BITS)


def _position(code: Column) -> Column:
    return (F.lit(_POSITION) - code.bitwiseAND(F.lit(_POSITION))).cast("int")


def _item_words(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words")).filter(
        F.size("words") > 0
    )


def benchmark_windows(items: DataFrame, guarantee: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row a distinct window: the hash of its fingerprint, the fingerprint's place, words and items."""
    k = _gram(guarantee)
    grams = guarantee - k + 1
    size = F.least(F.lit(WINDOW_WORDS), F.size("words"))
    starts = (
        _item_words(items, id_col, text_col)
        .withColumn("size", size)
        .select("item", "words", "size", F.explode(F.sequence(F.lit(0), F.size("words") - size)).alias("start"))
        .select("item", F.slice("words", F.col("start") + 1, F.col("size")).alias("window"))
    )
    head = F.slice("window", 1, guarantee)
    code = F.array_min(F.slice(let(head, lambda w: _codes(w, guarantee)), 1, grams))
    return (
        starts.groupBy("window")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .withColumn("code", code)
        .select(_hash(F.col("code")).alias("hash"), _position(F.col("code")).alias("place"), "window", "items")
    )


def item_bounds(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[int, int]:
    """(guarantee length, upper bound of the bytes of all windows): one small aggregate."""
    n = F.size("words")
    row = (
        _item_words(items, id_col, text_col)
        .agg(
            F.min(F.least(F.lit(WINDOW_WORDS), n)).alias("shortest"),
            # a word of a window takes 16 bytes besides its letters, rounded up to 8
            F.sum(n * (96 + 16 * WINDOW_WORDS) + 2 * WINDOW_WORDS * F.octet_length(F.array_join("words", " "))).alias("bytes"),
        )
        .first()
    )
    return row["shortest"] or WINDOW_WORDS, row["bytes"] or 0


def hash_bits(hashes: DataFrame) -> DataFrame:
    """(block, longs) rows that hold a set bit for every ``hash``: together at most MOST_BITS bits."""
    spark = hashes.sparkSession
    hashes = hashes.distinct()
    wanted = max(hashes.count() * BITS_PER_HASH, 1 << _ROW_BITS)
    n_bits = min(1 << (wanted - 1).bit_length(), MOST_BITS)
    slot = F.col("hash").bitwiseAND(F.lit(n_bits - 1))
    bit = F.expr("shiftleft(1L, cast(slot & 63 AS INT))")
    some = hashes.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("long")).agg(F.bit_or(bit).alias("bits"))
    longs = spark.range(n_bits >> 6).withColumnRenamed("id", "long").join(some, "long", "left")
    at = F.struct("long", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    rows = longs.groupBy(F.shiftright("long", _ROW_BITS - 6).alias("block")).agg(F.sort_array(F.collect_list(at)).alias("a"))
    return rows.select("block", F.lit(n_bits).alias("n_bits"), F.col("a.bits").alias("longs"))


def with_set_bits(grams: DataFrame, hashes: DataFrame) -> DataFrame:
    """The ``grams`` whose hash may be among ``hashes`` (or is negative); the table's size is bounded."""
    table = written(hash_bits(hashes), "bits")
    n_bits = table.agg(F.max("n_bits")).first()[0]
    slot = F.col("hash").bitwiseAND(F.lit(n_bits - 1))
    joined = grams.withColumn("block", F.when(F.col("hash") >= 0, F.shiftright(slot, _ROW_BITS))).join(
        F.broadcast(table.drop("n_bits")), "block", "left"
    )
    place = slot.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).cast("int")
    held = F.col("longs")[F.shiftright(place, 6)]
    # a one-bit field: shift it up to the sign
    set_ = F.call_function("shiftleft", held, F.lit(63) - place.bitwiseAND(F.lit(63))) < 0
    return joined.filter((F.col("hash") < 0) | set_).drop("block", "longs")


def matches(docs: DataFrame, items: DataFrame, broadcast_max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """(_row, doc_id, n_words, hits, items) of every row of ``keyed`` docs.

    hits: sorted (start, size) of the benchmark windows found; items: their
    sorted item ids.  Every document sends one row besides its hits, so that
    the texts are read once and only small rows are shuffled.
    """
    guarantee, window_bytes = item_bounds(items)
    reach = WINDOW_WORDS - 1
    windows = benchmark_windows(items, guarantee)
    bounded = window_bytes <= broadcast_max_bytes
    windows = F.broadcast(windows) if bounded else written(windows, "windows")
    # a document's own row has a negative hash, which no window has
    own = F.array(-F.col(ROW) - 1)
    grams = (
        docs.select(ROW, "doc_id", words_of(F.col("text")).alias("words"))
        .select(ROW, "doc_id", "words", fingerprints(F.col("words"), guarantee).alias("codes"))
        .select(ROW, "doc_id", "words", F.explode(F.concat(own, "codes")).alias("code"))
        .select(
            ROW,
            "doc_id",
            F.when(F.col("code") < 0, F.size("words")).cast("long").alias("n_words"),
            F.when(F.col("code") < 0, F.col("code")).otherwise(_hash(F.col("code"))).alias("hash"),
            _position(F.col("code")).alias("at"),
            "words",
        )
    )
    if not bounded:
        grams = with_set_bits(grams, windows.select("hash"))
    around = F.slice("words", F.greatest(F.col("at") - reach, F.lit(0)) + 1, 2 * reach + WINDOW_WORDS)
    grams = grams.select(ROW, "doc_id", "n_words", "hash", "at", F.when(F.col("hash") >= 0, around).alias("around"))
    if not bounded:
        windows = windows.hint("merge")
    joined = grams.join(windows, "hash", "left")
    start = F.col("at") - F.col("place")
    inside = start - F.greatest(F.col("at") - reach, F.lit(0))
    same = (inside >= 0) & (F.slice("around", F.greatest(inside, F.lit(0)) + 1, F.size("window")) == F.col("window"))
    checked = joined.select(
        ROW,
        "doc_id",
        "n_words",
        F.when(same, F.struct(start.alias("start"), F.size("window").alias("size"))).alias("hit"),
        F.when(same, F.col("items")).alias("items"),
    ).filter(F.col("n_words").isNotNull() | F.col("hit").isNotNull())
    return checked.groupBy(ROW, "doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set("hit")).alias("hits"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def _covered(hits: Column) -> Column:
    """Words inside any of the sorted (start, size) spans."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(acc: Column, hit: Column) -> Column:
        end = hit["start"] + hit["size"]
        new = F.greatest(F.lit(0), end - F.greatest(acc["end"], hit["start"]))
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + new).alias("n"))

    return F.aggregate(hits, zero, step, lambda acc: acc["n"]).cast("long")


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(_row, doc_id, n_words, n_hit, items, contaminated) of every row of ``keyed`` docs."""
    return (
        matches(docs, items)
        .withColumn("n_hit", _covered(F.col("hits")))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (MIN_HIT_SHARE * F.col("n_hit") >= F.col("n_words")))
        .drop("hits")
    )


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contamination(keyed(docs), items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def clean_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are not contaminated."""
    every = stored(rows(docs))
    texts = every.select(ROW, name(id_col, DOC).alias("doc_id"), name(text_col, DOC).alias("text"))
    found = contamination(texts, items).filter("contaminated").select(ROW)
    return every.join(found, ROW, "left_anti").select(*whole(docs))


_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: The judgement in DuckDB; ``{source}`` is the relation's name, its columns are kept.
SQL = f"""
WITH d AS (SELECT *, row_number() OVER () AS r, {_WORDS} AS w FROM {{source}}),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item_id, w, least({WINDOW_WORDS}, len(w)) AS n FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM bw)
), spans AS (
  SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, (SELECT DISTINCT n FROM bw))
), hit AS (
  SELECT r, s, n, item_id FROM spans JOIN windows USING (n, g)
), covered AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM hit) GROUP BY r
), found AS (
  SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS i FROM hit WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT d.* EXCLUDE (r, w), len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND {MIN_HIT_SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""

ORACLE = f"""
SELECT doc_id, n_words, n_hit, n_items, items_sha256, contaminated FROM ({SQL.format(source="documents")})
"""
