"""Quality rules: a threshold table compiled into one Spark projection.

``THRESHOLDS`` lists rules as (metric, lowest, highest); ``quality`` turns the
metrics and the table into one native projection (no user function, no
shuffle): text in, ratios and verdict out.

Defined cases: a null or empty text has no words, all counts 0, ratios 0, and
fails (fewer than 50 words); texts of any length are read whole; each row is
judged alone, so that ties cannot arise and repeated rows and ids do not matter;
an empty table gives an empty result, and extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility.llm.common import DOC, let, name, rows, whole

#: White space between words, and the symbols counted.
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Stop words of the four languages (lower case).
STOP_WORDS = (
    "the of and to in is that it for was on are with as be at by this have from or an he she they we not but his her "
    "de la le les des et en un une du que qui dans pour sur pas au par avec il elle "
    "der die das und den von zu mit sich auf ist im dem nicht ein eine als auch es "
    "el los las y se del con para una su al lo como"
).split()

#: (rule, metric, lowest allowed, highest allowed); None leaves a side open.
THRESHOLDS: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("word length", "mean_word_chars", 3.0, 12.0),
    ("symbols", "symbol_ratio", None, 0.1),
    ("stop words", "stop_ratio", 0.02, None),
    ("repeated lines", "dup_line_ratio", None, 0.5),
)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def _word_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def _repeat_words(words: Column) -> Column:
    """Words inside a 3-word window that occurs at least twice in the text.

    Window hashes only tell texts without any repeat (equal windows have equal
    hashes); the others sort their windows as strings, so the count is exact.
    """
    last = F.size(words) - 3

    def exact(_: Column) -> Column:
        windows = F.sort_array(
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: F.struct(
                    F.concat_ws(" ", words[i], words[i + 1], words[i + 2]).alias("gram"), i.alias("at")
                ),
            )
        )

        def positions(s: Column) -> Column:
            def repeated(j: Column) -> Column:
                gram = F.get(s, j)["gram"]
                before, after = F.get(s, j - 1)["gram"], F.get(s, j + 1)["gram"]
                return F.coalesce(gram == before, F.lit(False)) | F.coalesce(gram == after, F.lit(False))

            found = F.filter(F.sequence(F.lit(0), F.size(s) - 1), repeated)
            return F.sort_array(F.transform(found, lambda j: F.get(s, j)["at"]))

        def covered(p: Column) -> Column:
            steps = F.transform(p, lambda x, j: F.coalesce(F.least(F.lit(3), x - F.get(p, j - 1)), F.lit(3)))
            return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

        return let(let(windows, positions), covered)

    hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))
    any_repeat = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(last < 1, 0).otherwise(F.when(any_repeat, exact(words)).otherwise(0))


def metrics(text: Column) -> Column:
    """Struct of the counts of one text, evaluated in one pass of the row."""

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{SYMBOLS}]+", ""))
            .cast("long").alias("n_symbols"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
        )

    def lines(found: Column) -> Column:
        n = F.size(found).cast("long")
        return F.struct(n.alias("n_lines"), (n - F.size(F.array_distinct(found))).alias("n_dup_lines"))

    return F.struct(let(words_of(text), counts).alias("words"), let(_word_lines(text), lines).alias("lines"))


def compiled(thresholds=THRESHOLDS) -> Column:
    """The table as one boolean column over the metric columns."""
    passes = F.lit(True)
    for _, metric, low, high in thresholds:
        if low is not None:
            passes = passes & (F.col(metric) >= low)
        if high is not None:
            passes = passes & (F.col(metric) <= high)
    return passes


def quality(
    docs: DataFrame, text: Column | str = "text", keep: tuple[str, ...] = ("doc_id",), thresholds=THRESHOLDS
) -> DataFrame:
    """``keep`` columns, counts, ratios, ``base_failed`` and ``kept`` of every row."""

    def ratio(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    counted = docs.select(*keep, metrics(name(text) if isinstance(text, str) else text).alias("_m")).select(*keep, "_m.words.*", "_m.lines.*")
    return (
        counted.withColumns(
            {
                "mean_word_chars": ratio("word_chars", "n_words"),
                "symbol_ratio": ratio("n_symbols", "n_words"),
                "stop_ratio": ratio("n_stop_words", "n_words"),
                "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
                "base_failed": (F.col("n_words") < MIN_WORDS)
                | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
            }
        ).withColumn("kept", ~F.col("base_failed") & compiled(thresholds))
    )


def kept_documents(docs: DataFrame, text_col: str = "text", thresholds=THRESHOLDS) -> DataFrame:
    """The rows of ``docs`` (all their columns) that pass; others are dropped."""
    judged = quality(rows(docs), name(text_col, DOC), (DOC,), thresholds)
    return judged.filter("kept").select(*whole(docs))


def query(docs: DataFrame) -> DataFrame:
    return quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _sql_rules() -> str:
    parts = [f"{m} >= {low}" for _, m, low, _ in THRESHOLDS if low is not None]
    return " AND ".join(parts + [f"{m} <= {high}" for _, m, _, high in THRESHOLDS if high is not None])


#: The same rows in DuckDB; FROM takes the relation's name.
SQL = f"""
WITH w AS (
  SELECT *, row_number() OVER () AS r, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM {{source}}
), grams AS (
  SELECT r, p, words[p] || ' ' || words[p + 1] || ' ' || words[p + 2] AS g
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS p FROM w)
), repeated AS (
  SELECT r, count(DISTINCT q) AS n_repeat_words
  FROM (SELECT r, unnest([p, p + 1, p + 2]) AS q
        FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1)
  GROUP BY r
), counted AS (
  SELECT w.* EXCLUDE (t, words), len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(list_filter(words, lambda x: lower(x) IN ({_sql_list(STOP_WORDS)}))) AS n_stop_words,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM w LEFT JOIN repeated USING (r)
), judged AS (
  SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_ratio,
         CASE WHEN n_words > 0 THEN n_stop_words / n_words ELSE 0 END AS stop_ratio,
         CASE WHEN len(lines) > 0 THEN (len(lines) - len(list_distinct(lines))) / len(lines) ELSE 0 END
           AS dup_line_ratio
  FROM counted
)
SELECT *, NOT base_failed AND {_sql_rules()} AS kept FROM judged
"""

ORACLE = f"""
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, kept
FROM ({SQL.format(source="documents")})
"""
