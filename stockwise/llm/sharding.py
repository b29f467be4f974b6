"""Sharding by vector bin packing: bytes, tokens and rows of every shard come out near equal at once.

Rows are gathered into items: a group of equal texts that is larger than a block in bytes, tokens or rows is an item of
its own (several, if it is a good part of a shard in any of them), all other groups are hashed into blocks.  Only the items' sums
reach the driver; their number depends on ``shards * blocks`` and on ``rows / cell_rows``.  Items are placed by descending size,
each on the shard where the dot product of its sizes with the shard's residual capacity is highest; last moves even out what
is left.  Slots follow from prefix sums over cells, small parts of an item that one task can number.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from stockwise.session import staged

DIMENSIONS = ("bytes", "tokens", "rows")


def place(sizes: np.ndarray, shards: int, moves: int = 4000) -> np.ndarray:
    """The shard of every item (one row of sizes per item): dot-product packing into equal shards, then moves.

    All dimensions weigh the same.  A move takes an item out of the shard that is furthest above the mean in some dimension,
    if that lowers the sum of squared loads; bytes weigh more there, so that what is left uneven is not the bytes.
    """
    total = np.maximum(sizes.sum(axis=0), 1e-9)
    vectors = sizes * (shards / total)
    residual = np.full((shards, sizes.shape[1]), 1.0)
    out = np.zeros(len(sizes), dtype=np.int64)
    for i in np.lexsort((np.arange(len(sizes)), -vectors.max(axis=1))):
        k = int(np.argmax(residual @ vectors[i]))
        residual[k] -= vectors[i]
        out[i] = k
    weights = np.array([4.0, 1.0, 1.0])
    closed = np.zeros(shards, bool)
    for _ in range(moves):
        over = np.where(closed, -np.inf, (-residual * np.sqrt(weights)).max(axis=1))
        k = int(np.argmax(over))
        if over[k] <= 1e-3:
            break
        own = np.flatnonzero(out == k)
        v = vectors[own] * weights
        change = (v * vectors[own]).sum(axis=1)[:, None] + v @ (residual[k][:, None] - residual.T)
        change[:, k] = 0.0
        i, to = np.unravel_index(int(np.argmin(change)), change.shape)
        if change[i, to] >= -1e-9:
            closed[k] = True
            continue
        residual[k] += vectors[own[i]]
        residual[to] -= vectors[own[i]]
        out[own[i]] = to
        closed[:] = False
    return out


def measured(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, size, tokens, text_crc32, key``; tokens are counted by blanks."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("body"))
    n = F.octet_length("body").cast("long")
    return rows.select(
        "doc_id",
        (n + 16).alias("size"),
        (n - F.octet_length(F.replace("body", F.lit(" "), F.lit(""))) + 1).cast("long").alias("tokens"),
        F.crc32(F.col("body").cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2("body", 256)).alias("key"),
    )


def pack_into_shards(
    docs: DataFrame,
    shards: int = 40,
    id_col: str = "doc_id",
    text_col: str = "text",
    blocks: int = 256,
    cell_rows: int = 50_000,
) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, shard, slot``.

    size: UTF-8 bytes of the text plus 16.  Rows with equal texts share a shard, unless they make up more than a
    quarter of a shard's bytes, tokens or rows; such a group is dealt in parts by a hash of the id.

    Defined cases: a null text counts as empty (size 16).  Null ids share one hash; rows that repeat an id get
    slots of their own.  An empty table gives no rows.  Other columns are not read.
    """
    spark = docs.sparkSession
    narrow = staged(measured(docs, id_col, text_col), "sizes")
    totals = narrow.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    totals = [max(1, x or 0) for x in totals]
    n_blocks = shards * blocks

    # In each dimension at most n_blocks groups are larger than a block.
    shares = [F.col(c) / F.lit(float(t)) for c, t in zip(DIMENSIONS, totals, strict=True)]
    large = (
        narrow.groupBy("key")
        .agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
        .filter(F.greatest(*shares) > 1 / n_blocks)
        .collect()
    )
    listed, base = [], n_blocks
    for r in sorted(large, key=lambda r: bytes(r["key"])):
        share = max(r[c] * shards / t for c, t in zip(DIMENSIONS, totals, strict=True))
        # A group that is cut is cut finely: whole quarters could not be dealt evenly.
        parts = min(r["rows"], math.ceil(share * 32)) if share > 0.25 else 1
        listed.append((r["key"], base, parts))
        base += parts
    schema = T.StructType(
        [T.StructField("key", T.BinaryType())] + [T.StructField(c, T.LongType()) for c in ("base", "parts")]
    )
    marked = narrow.join(F.broadcast(spark.createDataFrame(listed, schema)), "key", "left")
    dealt = marked.select(
        "doc_id",
        "size",
        "tokens",
        "text_crc32",
        F.coalesce(
            F.col("base") + F.pmod(F.xxhash64("doc_id"), F.col("parts")),
            F.pmod(F.xxhash64("key"), F.lit(n_blocks)),
        ).alias("item"),
    )
    # An item has as many cells as its own rows ask for; the list of those with several is short.
    split = dealt.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > cell_rows)
    split = [(r[0], -(-r[1] // cell_rows)) for r in split.collect()]
    dealt = dealt.join(F.broadcast(spark.createDataFrame(split, "item long, cells long")), "item", "left")
    dealt = dealt.withColumn("cell", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.coalesce("cells", F.lit(1)))).drop("cells")
    cells = sorted(
        tuple(r)
        for r in dealt.groupBy("item", "cell")
        .agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1)))
        .collect()
    )
    schema = "item long, cell long, shard int, base long"
    if cells:
        table = np.array(cells, dtype=np.int64)
        items, index = np.unique(table[:, 0], return_inverse=True)
        sizes = np.zeros((len(items), 3))
        np.add.at(sizes, index, table[:, 2:].astype(float))
        shard_of = place(sizes, shards)[index]
        starts = np.zeros(len(table), dtype=np.int64)
        for k in range(shards):
            own = np.flatnonzero(shard_of == k)
            starts[own] = np.cumsum(table[own, 4]) - table[own, 4]
        placed = [(int(r[0]), int(r[1]), int(s), int(b)) for r, s, b in zip(table, shard_of, starts, strict=True)]
    else:
        placed = []
    within = Window.partitionBy("item", "cell").orderBy("doc_id", "text_crc32", "size")
    ranked = dealt.withColumn("rank", F.row_number().over(within).cast("long") - 1)
    return ranked.join(spark.createDataFrame(placed, schema), ["item", "cell"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("rank")).alias("slot")
    )
