r"""Secret scans by corpus-wide ownership frequency, on native functions only.

Base patterns and a wider high-entropy pattern propose candidate values.  The
digest of every value is aggregated over the whole corpus by distinct
repositories and owners: a value in the hands of many owners, or in many
repositories of each, is a widely copied example; one that few owners hold in
few places looks like a live credential of theirs.  Base findings are always reported, with that verdict; high-entropy
candidates are added only where the corpus says they are owner-specific.

Positions come from native functions too: the pieces between matches (split)
and the matches themselves (regexp_extract_all) alternate, so running sums of
their lengths give each match's start and end in code points.  Only texts with
a match send rows, and a text's matches are spread as rows, not nested sums.

Defined cases: null or empty texts have no findings; texts of any length are
searched whole, at a cost in proportion to their length and matches; repeated
rows are scanned each on its own (and count as one owner's copy); of spans that
start together the order is by kind as listed; a null owner or repository counts
as one more; an empty table gives an empty result; extra columns are not read
(``masked_documents`` passes them on).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobility.llm.common import DOC, ROW, name, rows, stored, whole, written

#: A value held by more distinct owners than this is a copied example.
MAX_OWNERS = 2
#: So is a value in more distinct repositories than this for each of its owners.
MAX_REPOS = 10
#: Characters masked at a time.
BLOCK = 1024


@dataclass(frozen=True)
class Kind:
    """One pattern; a match fails if its value is shorter than ``least``."""

    name: str
    pattern: str
    group: int
    least: int
    base: bool = True


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(either_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))

#: The base patterns, in the order in which they are listed.
BASE = (
    Kind("assign", rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Kind("access", "AKIA[A-Z0-9]+", 0, 20),
    # runs under 24 characters fail and cannot hide a longer one, so they are left out of the search
    Kind("hex", "[0-9a-f]{24,}", 0, 24),
)
#: High-entropy candidates: long runs of the base64 and URL-safe alphabets.
ENTROPY = Kind("entropy", "[A-Za-z0-9+/_=-]{20,}", 0, 20, base=False)
KINDS = (*BASE, ENTROPY)


def _pieces(text: Column, kind: Kind) -> Column:
    """Array of (seg, match, value): what precedes each match, the match, its value."""
    whole = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(kind.group)) if kind.group else whole
    seg = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(whole))
    return F.struct(F.lit(kind.name).alias("kind"), F.arrays_zip(seg.alias("seg"), whole.alias("m"), value.alias("v")).alias("p"))


def _looks_random(value: Column) -> Column:
    """Letters and at least four digits, in no fewer than ten distinct characters, not one repeated run."""
    digits = F.length(F.regexp_replace(value, "[^0-9]+", ""))
    return (
        (digits >= 4)
        & value.rlike("[A-Za-z]")
        & (F.size(F.array_distinct(F.split(value, ""))) >= 10)
        & (digits * 10 <= F.length(value) * 9)
    )


def holders(every: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """(_row, doc_id, text, repo, owner) of every stored row."""
    return every.select(
        ROW,
        name(id_col, DOC).alias("doc_id"),
        name(text_col, DOC).alias("text"),
        name(repo_col, DOC).cast("string").alias("repo"),
        name(owner_col, DOC).cast("string").alias("owner"),
    )


def candidates(docs: DataFrame) -> DataFrame:
    """(_row, repo, owner, kind, start, end, digest) of every match in ``holders`` that does not fail."""
    text = F.col("text")
    found = F.array(*[F.when(text.rlike(k.pattern), _pieces(text, k)) for k in KINDS])
    matched = (
        docs.select(ROW, "repo", "owner", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("f"))
        .select(ROW, "repo", "owner", "f.kind", F.posexplode("f.p").alias("i", "p"))
        .select(
            ROW,
            "repo",
            "owner",
            "kind",
            "i",
            F.length("p.seg").cast("long").alias("seg"),
            F.length("p.m").cast("long").alias("size"),
            F.col("p.v").alias("value"),
        )
        .repartition(ROW)
    )
    before = Window.partitionBy(ROW, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    least = F.create_map(*[x for k in KINDS for x in (F.lit(k.name), F.lit(k.least))])
    return (
        matched.withColumn("end", F.sum(F.col("seg") + F.col("size")).over(before))
        .withColumn("start", F.col("end") - F.col("size"))
        .filter(F.length("value") >= least[F.col("kind")])
        .filter((F.col("kind") != ENTROPY.name) | _looks_random(F.col("value")))
        .select(ROW, "repo", "owner", "kind", "start", "end", F.sha2("value", 256).alias("digest"))
    )


def without_base_overlap(found: DataFrame) -> DataFrame:
    """Drops added candidates that share a character with a base finding of their text."""
    base = F.col("kind") != ENTROPY.name
    place = [F.col("start"), F.when(base, 0).otherwise(1), F.col("end")]
    # running extremes in either order: a frame that ends at the last row would be computed anew for each row
    so_far = Window.partitionBy(ROW).rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(base, F.col("end"))).over(so_far.orderBy(*place))
    ahead = F.min(F.when(base, F.col("start"))).over(so_far.orderBy(*[p.desc() for p in place]))
    return (
        found.withColumns({"_reach": reach, "_ahead": ahead})
        .filter(
            base
            | (
                (F.coalesce(F.col("_reach"), F.lit(0)) <= F.col("start"))
                & (F.col("_ahead").isNull() | (F.col("_ahead") >= F.col("end")))
            )
        )
        .drop("_reach", "_ahead")
    )


def ownership(found: DataFrame) -> DataFrame:
    """(digest, n_owners, n_repos) over the whole corpus, without nulls being lost.

    Distinct (digest, owner, repo) first: a value copied into a third of the
    corpus is thinned by partial aggregation before it is counted.
    """
    holders = found.select("digest", "owner", "repo").distinct()
    repos = holders.groupBy("digest", "owner").agg(F.count(F.lit(1)).alias("n"))
    return repos.groupBy("digest").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repos"))


def scan(docs: DataFrame, max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> DataFrame:
    """(_row, kind, start, end, digest, n_owners, n_repos, live) of every reported finding in ``holders``.

    The findings are written once, so that the texts are searched once.
    """
    found = written(without_base_overlap(candidates(docs)), "findings")
    judged = found.join(ownership(found), "digest")
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos * F.col("n_owners"))
    return judged.withColumn("live", live).filter((F.col("kind") != ENTROPY.name) | live).drop("repo", "owner")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def by_document(docs: DataFrame) -> DataFrame:
    """One row a document of ``holders`` with the sorted spans of each class, documents without findings included."""
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k.name), F.lit(i))])
    span = F.struct("start", rank[F.col("kind")].alias("rank"), "kind", "end", F.col("n_repos").alias("repos"))
    base = F.col("kind") != ENTROPY.name
    found = (
        scan(docs)
        .groupBy(ROW)
        .agg(
            F.sort_array(F.collect_list(F.when(base, span))).alias("base_spans"),
            F.sort_array(F.collect_list(span)).alias("all_spans"),
            F.count(F.when(F.col("live"), 1)).alias("n_live"),
            F.count(F.when(~F.col("live"), 1)).alias("n_examples"),
        )
    )
    every = docs.select(ROW, "doc_id")
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,repos:bigint>>")
    return every.join(found, ROW, "left").withColumns(
        {
            "base_spans": F.coalesce("base_spans", empty),
            "all_spans": F.coalesce("all_spans", empty),
            "n_live": F.coalesce("n_live", F.lit(0)),
            "n_examples": F.coalesce("n_examples", F.lit(0)),
        }
    )


def query(docs: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    every = stored(rows(docs.select("doc_id", "text", "source")))
    return by_document(holders(every)).select(
        "doc_id",
        *[count(k.name) for k in BASE],
        F.sha2(_listed(F.col("base_spans")), 256).alias("base_sha256"),
        _listed(F.col("all_spans")).alias("spans"),
        F.array_join(F.col("all_spans.repos").cast("array<string>"), ",").alias("span_repos"),
        "n_live",
        "n_examples",
    )


def _merged(found: DataFrame) -> DataFrame:
    """(_row, start, end) of the findings, overlapping ones as one."""
    before = Window.partitionBy(ROW).orderBy("start", "end")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach > F.col("start"), 0).otherwise(1)
    runs = found.select(ROW, "start", "end", fresh.alias("fresh")).withColumn(
        "run", F.sum("fresh").over(before.rowsBetween(Window.unboundedPreceding, 0))
    )
    return runs.groupBy(ROW, "run").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("run")


def _masked_block(text: Column, at: Column, spans: Column, mask: str) -> Column:
    """A block of text (its first character is ``at``) with its spans masked, each where it starts."""
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).cast("long").alias("end"))

    def step(acc: Column, s: Column) -> Column:
        first = F.greatest(s["start"] - at, F.lit(0))
        gap = F.substring(text, (acc["end"] + 1).cast("int"), (first - acc["end"]).cast("int"))
        shown = F.when(s["start"] >= at, F.array(gap, F.lit(mask))).otherwise(F.array(gap))
        return F.struct(F.concat(acc["out"], shown).alias("out"), (s["end"] - at).alias("end"))

    def close(acc: Column) -> Column:
        rest = F.greatest(F.length(text) - acc["end"], F.lit(0))
        return F.concat(F.array_join(acc["out"], ""), F.substring(text, (acc["end"] + 1).cast("int"), rest.cast("int")))

    return F.aggregate(F.sort_array(spans), start, step, close)


def masked_texts(texts: DataFrame, found: DataFrame, mask: str) -> DataFrame:
    """(_row, text) of the ``texts`` (_row, text) that have spans in ``found``, masked.

    Texts are taken in blocks of BLOCK characters, so that neither a long text
    nor many spans in one cost more than in proportion.
    """
    spans = _merged(found)
    first, last = (F.floor(x / BLOCK) for x in (F.col("start"), F.col("end") - 1))
    hit = (
        spans.select(ROW, F.struct("start", "end").alias("span"), F.explode(F.sequence(first, last)).alias("block"))
        .groupBy(ROW, "block")
        .agg(F.collect_list("span").alias("spans"))
    )
    cut = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    blocks = texts.join(spans.select(ROW).distinct(), ROW, "left_semi").select(ROW, F.posexplode(cut).alias("block", "part"))
    masked = _masked_block(F.col("part"), F.col("block").cast("long") * BLOCK, F.col("spans"), mask)
    done = blocks.withColumn("block", F.col("block").cast("long")).join(hit, [ROW, "block"], "left").select(
        ROW, F.struct("block", F.when(F.col("spans").isNull(), F.col("part")).otherwise(masked).alias("part")).alias("b")
    )
    return done.groupBy(ROW).agg(F.array_join(F.sort_array(F.collect_list("b"))["part"], "").alias("text"))


def masked_documents(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]", **columns: str) -> DataFrame:
    """``docs`` with every reported span of the text replaced by ``mask``; all rows and columns stay.

    Overlapping spans are masked as one; texts without findings are passed on as they are.
    """
    every = stored(rows(docs))
    held = holders(every, text_col=text_col, **columns)
    found = written(scan(held).select(ROW, "start", "end"), "spans")
    masked = masked_texts(held.select(ROW, "text"), found, mask).select(ROW, F.col("text").alias("_masked"))
    text = F.coalesce("_masked", name(text_col, DOC))
    changed = {text_col: text, "n_chars": F.length(text).cast("long")}
    joined = every.join(masked, ROW, "left")
    return joined.select(*[changed[c].alias(c) if c in changed else x for c, x in zip(docs.columns, whole(docs))])
