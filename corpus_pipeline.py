"""Training-corpus pipeline: each stage takes (spark, docs, sf_dir) and returns a DataFrame.

Every stage is written as Parquet and read back as the next one's ``docs``.
All but the last return the columns of ``documents`` (and whatever else the
input has, under any names); what a stage rejects is gone for the later ones.

In every stage texts of any length are read whole, a null or an empty table is
no error, rows may share ids or be equal, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mobility.llm import decontaminate, jaccard_join, packing, quality, secret_scan
from mobility.llm.common import run_folder, shared_dir, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules; the others go, those without words (null texts too) among them.

    Each row is judged alone: ties cannot arise, repeated rows stay or go together.
    """
    return quality.kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every component of similar ones: the one with the least id.

    Shingles of five words and a similarity of at least 0.8.  Of rows that tie
    for the least id (null ids come last) the first one read stays, so of
    repeated rows one does; documents without words (null texts too) all stay.
    """
    return jaccard_join.one_of_each(docs, percent=80, shingle=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without enough of the benchmark's texts; those without words (null texts too) stay.

    Each row is judged alone; an empty benchmark removes none.
    """
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secrets_masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts masked (n_chars follows the text); a null text stays null.

    Spans that overlap are masked as one; each of repeated rows is masked.
    """
    return secret_scan.masked_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document with their place in sequences of at most 2048 tokens.

    A null or empty text is its end id alone; repeated rows are packed each on
    its own; pieces of one length may take each other's places.
    """
    return packing.query(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets_masked", secrets_masked),
    ("packed_sequences", packed_sequences),
]

#: SQL cannot express the tokenizer of the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written and read back.

    What a stage writes besides is removed when its rows are there; the rows of
    the stages, and what the last one's result is read from, are the caller's to
    remove (see ``mobility.llm.common.run_folder``).
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/{name}"
        with run_folder(spark):
            found = stage(spark, docs, sf_dir)
            found.write.parquet(path)
        docs = spark.read.schema(found.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
