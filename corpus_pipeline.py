"""The corpus pipeline: quality, language, exact copies, near copies, packing.

Every stage works on all documents its predecessor kept.  All but the last give the columns of ``documents``; the last gives
one row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stockwise.llm.binary import token_lengths
from stockwise.llm.dedup import without_copies
from stockwise.llm.langid import keep_identified
from stockwise.llm.neardup import without_near_copies
from stockwise.llm.packing import pack
from stockwise.llm.quality import keep_good
from stockwise.llm.queries import learned_languages, learned_quality, table, vocabulary
from stockwise.session import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at least 0.7 under a classifier learned from the labelled ones.

    Null, empty and blank texts get the share of good documents in the sample and stay or go by that; a document is judged by its whole
    text; rows that repeat are judged each, null ids and clashing columns are passed on; an empty table gives no rows.
    """
    return keep_good(docs, learned_quality(docs, table(spark, sf_dir, "labels")), 0.7)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language.

    Null, empty and letterless texts go, and those of which too few n-grams are known; texts too short to tell stay.  Rows that repeat are
    judged each, null ids and clashing columns are passed on; an empty table gives no rows.
    """
    return keep_identified(docs, learned_languages(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id.

    Null counts as empty; rows that repeat id and text stay together; a group of null ids only stays whole; an id's other texts are
    judged by themselves; an empty table gives no rows.
    """
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents the one with the smallest id.

    Texts without words are linked with nothing and stay, as do rows with a null id; rows that repeat the kept id stay; whole texts are
    compared; an empty table gives no rows.
    """
    return without_near_copies(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, counted in tokens, in bins of several permitted lengths."""
    return pack(token_lengths(docs, vocabulary("word_bpe_49k.json")))


STAGES = [
    ("quality", quality),
    ("language", language),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("packing", packing),
]

#: The stages learn models and link documents, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written once and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
