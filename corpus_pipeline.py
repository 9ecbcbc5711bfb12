"""The corpus pipeline: line-first quality rules, near-duplicates, repeated passages, leaks, packing.

Every stage takes what its predecessor kept and returns the columns of ``documents``; the last returns the
packed pieces. Each stage's result is a Parquet table in the shared folder, so a lost executor costs no more
than the tasks it ran.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from readloom.llm import decontam, jaccard, packing, quality, suffix
from readloom.llm.common import Scratch, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the line rules keep, their text without the lines that failed.

    Null and empty texts are rejected, equal rows are judged alike, other columns stay, an empty table stays empty.
    """
    return quality.clean(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at five-word shingles and a similarity of 0.8.

    The smallest doc_id stays, null ids last; of rows that share it the first. Texts without words all stay,
    other columns are kept, an empty table stays empty.
    """
    return jaccard.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the strings of ``suffix.PASSAGE`` bytes that occur more than once.

    Passages of over 50 words are longer. Null and empty texts stay as they are, no row is dropped, other
    columns are kept, equal rows lose all of a text of that length, an empty table stays empty.
    """
    return suffix.without_repeats(docs, suffix.PASSAGE, suffix.PASSAGE_SPREAD)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item.

    Null and empty texts hold none, equal rows stay or go together, other columns are kept. Without items every
    document stays; an empty table stays empty.
    """
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents left, each with its sequence and place.

    A null text is one piece that holds the end token; rows that share an id are packed row by row; other columns
    are not read; an empty table gives an empty table.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Repeats and the packing of sequences are beyond plain SQL; the stages have brute-force tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
