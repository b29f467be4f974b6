"""Exact dedup: equal texts, found by digests and confirmed on full content, without Python on the rows.

Rows are first narrowed to (id, digest, second hash).  The texts themselves are then combined in three steps,
each of which groups by the digest **and the whole text**: inside a map task (the partial aggregate), among the
rows of one salt, and over the salts.  Only digests that hold at least ``1 / hot_share`` of the rows are salted; there
are at most ``hot_share`` of them, which bounds the broadcast list and the second text shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stockwise.llm.skew import looked_up
from stockwise.session import staged

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def folded(text: str | Column) -> Column:
    """Lower-cases A-Z only; null counts as empty.

    For pure ASCII the built-in ``lower`` does just that and is several times faster than ``translate``.
    """
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def digested(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the folded text ``body``, its SHA-256 ``digest`` (binary) and a second hash ``mark``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), folded(text_col).alias("body"))
    return rows.select("doc_id", "body", F.unhex(F.sha2("body", 256)).alias("digest"), F.xxhash64("body").alias("mark"))


def salted_winners(rows: DataFrame, hot: DataFrame, salts: int) -> DataFrame:
    """Per distinct text: ``digest``, ``mark``, the largest id ``keep_id`` and ``group_size``.

    rows: ``doc_id, body, digest, mark``; hot: a bounded list of digests to be salted.
    """
    marked = rows.join(F.broadcast(hot.select("digest", F.lit(True).alias("is_hot"))), "digest", "left")
    marked = marked.withColumn("is_hot", F.coalesce("is_hot", F.lit(False))).withColumn(
        "salt", F.when(F.col("is_hot"), F.pmod(F.xxhash64("doc_id"), F.lit(salts))).otherwise(F.lit(0))
    )
    # max(is_hot) is an aggregate, so the filters below stay above the shuffle and both branches share it.
    local = marked.groupBy("digest", "salt", "mark", "body").agg(
        F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.max("is_hot").alias("salted")
    )
    cold = local.filter(~F.col("salted")).select("digest", "mark", "keep_id", "group_size")
    merged = (
        local.filter("salted")
        .groupBy("digest", "mark", "body")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
        .select("digest", "mark", "keep_id", "group_size")
    )
    return cold.unionByName(merged)


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot_share: int = 1000, salts: int = 32
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; of equal texts the row with the largest id stays.

    Defined cases: a null text equals the empty text.  A null id never wins against another id; if a group
    has null ids only, ``keep_id`` is null and its rows are kept.  A row that repeats both id and text of the kept
    row counts as that row (kept too).  An empty table gives no rows.  Other columns are not read.
    """
    total = docs.count()
    narrow = staged(digested(docs, id_col, text_col).select("doc_id", "digest", "mark"), "digests")
    hot = narrow.groupBy("digest").count().filter(F.col("count") >= max(2, total // hot_share)).select("digest")
    winners = staged(salted_winners(digested(docs, id_col, text_col), hot, salts), "winners")
    frequent = winners.filter(F.col("group_size") >= max(2, total // hot_share))
    joined = looked_up(narrow, winners, ["digest", "mark"], frequent)
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Defined cases as in :func:`exact_groups`: of equal texts (null counts as empty) the row with the largest id stays, together with rows
    that repeat both its id and its text; an id that also stands on other texts does not keep those.  If a group has null ids
    only, all its rows stay.  Whole texts count, however long; an empty table gives no rows; columns of any name are passed on.
    """
    kept = exact_groups(docs, id_col, text_col, **options).filter("kept")
    keys = kept.select(F.col("doc_id").alias("__kept_id"), F.unhex("text_sha256").alias("__kept_digest")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("__kept_id")) & (F.unhex(F.sha2(folded(text_col), 256)) == F.col("__kept_digest"))
    return docs.join(keys, same, "left_semi")
