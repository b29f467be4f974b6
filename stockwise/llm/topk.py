"""Exact top-k search by inner product.

Vectors are dealt into bands by descending length.  A band's task holds its vectors in an array, rotated so that the
first coordinates carry most of the inner products (right singular vectors of a bounded sample), and the queries stream past.
Cauchy-Schwarz bounds prune three times: a query visits a band only if the product of lengths can reach the k-th best score it
already has from the longest vectors; inside a band a block of vectors is skipped in the same way; and of the
rest only those pairs are computed whose partial sum plus the product of the residual lengths can reach it.  Scores are
exact integers, of any size where 64 bits may not do; pruning only ever uses upper bounds with a margin for rounding.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from stockwise.llm.langid import hashed_share
from stockwise.llm.workers import map_batches
from stockwise.session import staged

#: Scaled components from here on raise an error: their squares are near the end of double precision.
LARGEST = 2.0**490
#: Inner products whose lengths multiply to less are summed in 64 bits, all others in integers of any size.
NARROW = 2.0**62
LONGEST = (1 << 63) - 1
BLOCK = 1024


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, values, length2``: floor(scale * x) of all components, and the squared length.

    Values are 32-bit integers; if one does not fit, all of the vector's are doubles (which hold them exactly), with one more byte as
    mark.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows, squares = [], [], []
            for key, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if key is None or not row.is_valid or row.values.null_count:
                    continue
                raw = row.values.to_numpy(zero_copy_only=False).astype(np.float64)
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(scale * raw)
                if not np.isfinite(raw).all():
                    continue
                most = np.abs(x).max(initial=0.0)
                if not most < LARGEST:
                    raise ValueError(f"vector {key}: a component is too large for exact scores")
                keys.append(key)
                rows.append(x.astype("<i4").tobytes() if most < 1 << 31 else x.astype("<f8").tobytes() + b"\0")
                squares.append(float((x**2).sum()))
            columns = [pa.array(keys, pa.int64()), pa.array(rows, pa.binary()), pa.array(squares, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "values", "length2"])

    rows = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].alias("vector"))
    whole = map_batches(rows, run, "vec_id long, values binary, length2 double")
    return whole.groupBy("vec_id").agg(F.min(F.struct("values", "length2")).alias("v")).select("vec_id", "v.*")


def matrix(rows: list[bytes], width: int) -> np.ndarray:
    """One row per vector, shorter ones padded with zeros."""
    out = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        x = np.frombuffer(r, "<f8", len(r) // 8) if len(r) % 4 else np.frombuffer(r, "<i4")
        out[k, : len(x)] = x
    return out


def exact_scores(rows: np.ndarray, query: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers; ``reach``: upper bounds of their size.  Python integers if one may not fit 64 bits."""
    wide = reach >= NARROW
    narrow = np.where(wide[:, None], 0.0, rows).astype(np.int64) @ query.astype(np.int64) if not wide.all() else np.zeros(len(rows), np.int64)
    if not wide.any():
        return narrow
    out = narrow.astype(object)
    whole = np.frompyfunc(int, 1, 1)
    out[wide] = whole(rows[wide]) @ whole(query)
    return out


class Rotated:
    """Vectors by descending length, with their rotation's first coordinates and the lengths of what is left."""

    def __init__(self, ids: np.ndarray, exact: np.ndarray, basis: np.ndarray):
        lengths = np.sqrt((exact**2).sum(axis=1))
        order = np.lexsort((ids, -lengths))
        self.ids, self.exact, self.lengths = ids[order], exact[order], lengths[order]
        self.head, self.rest = project(self.exact, basis)

    def best(self, keys: np.ndarray, queries: np.ndarray, basis: np.ndarray, k: int, floor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the ids and scores of its ``k`` best vectors here, of those that reach ``floor``."""
        head, rest = project(queries, basis)
        lengths = np.sqrt((queries**2).sum(axis=1))
        floor = floor.copy()
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(keys)
        for start in range(0, len(self.ids), BLOCK):
            at = slice(start, start + BLOCK)
            # Lengths fall, so a query that no vector of this block can serve is done.
            open_queries = np.flatnonzero(raised(lengths * self.lengths[start]) >= floor)
            if not len(open_queries):
                break
            bound = raised(head[open_queries] @ self.head[at].T + np.outer(rest[open_queries], self.rest[at]))
            maybe = bound >= floor[open_queries][:, None]
            maybe &= keys[open_queries][:, None] != self.ids[at][None, :]
            for row in np.flatnonzero(maybe.any(axis=1)):
                q = open_queries[row]
                chosen = np.flatnonzero(maybe[row])
                scores = exact_scores(self.exact[at][chosen], queries[q], lengths[q] * self.lengths[at][chosen])
                ids, scores = np.concatenate((found[q][0], self.ids[at][chosen])), np.concatenate((found[q][1], scores))
                if scores.dtype == object:
                    order = np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k])
                else:
                    order = np.lexsort((ids, -scores))[:k]
                found[q] = ids[order], scores[order]
                if len(order) == k:
                    floor[q] = max(floor[q], float(scores[order[-1]]))
        return found


def project(x: np.ndarray, basis: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    head = x @ basis
    rest = np.sqrt(np.maximum(0.0, (x**2).sum(axis=1) - (head**2).sum(axis=1)))
    # The difference of squares loses digits; a rest that is too long only prunes less.
    return head, rest + 1e-6 * np.sqrt((x**2).sum(axis=1))


def raised(bound: np.ndarray) -> np.ndarray:
    return bound + 1e-6 * np.abs(bound) + 1e-3


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
    band_rows: int = 8192,
    query_rows: int = 65_536,
    sample_rows: int = 20_000,
    head: int = 16,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` vectors of highest inner product for every id divisible by ``every``.

    Components are floor(``scale`` * x); of equal scores the smaller id comes first; a query is no candidate of
    its own.  The rotation is learned from about ``sample_rows`` vectors, taken by a hash of the id; it decides speed only.

    Scores are exact for every finite vector.  A score among the ``k`` best that does not fit a long raises an error, as does a
    scaled component of 2 ** 490 or more.

    Defined cases: rows with a null id, a null vector, a null or non-finite component take no part.  Rows that repeat an id count once (the smallest vector in byte order).  Of vectors of different
    dimension the shorter one is padded with zeros.  An empty table gives no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    whole = staged(quantised(vectors, id_col, vector_col, scale), "vectors")
    n = F.octet_length("values")
    rows, width = whole.agg(F.count(F.lit(1)), F.max(F.when(n % 4 == 0, n / 4).otherwise((n - 1) / 8))).first()
    width = max(1, int(width or 0))
    sample = whole.filter(hashed_share("vec_id") < sample_rows / max(1, rows)).select("values").collect()
    moment = matrix([bytes(r[0]) for r in sample], width)
    if len(moment):  # a few outliers must not take the rotation's coordinates
        lengths = np.sqrt((moment**2).sum(axis=1))
        moment *= np.minimum(1.0, 10 * max(1.0, np.median(lengths)) / np.maximum(lengths, 1.0))[:, None]
    _, axes = np.linalg.eigh(moment.T @ moment)
    basis = axes[:, ::-1][:, : min(head, width)].copy()

    longest = whole.orderBy(F.desc("length2"), "vec_id").limit(BLOCK).collect()
    shared = spark.sparkContext.broadcast(
        (np.array([r[0] for r in longest], np.int64), matrix([bytes(r[1]) for r in longest], width), basis)
    )

    def seed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, exact, basis = shared.value
        first = Rotated(ids, exact, basis)
        for batch in batches:
            keys = batch.column(0).to_numpy()
            queries = matrix(batch.column(1).to_pylist(), exact.shape[1])
            floors = np.full(len(keys), -np.inf)
            for i, (_, scores) in enumerate(first.best(keys, queries, basis, k, floors)):
                if len(scores) == k:
                    floors[i] = scores[-1]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floors)], names=["vec_id", "values", "length2", "floor"])

    queries = whole.filter(F.col("vec_id") % every == 0)
    queries = map_batches(queries, seed, "vec_id long, values binary, length2 double, floor double")
    bands = max(1, -(-rows // band_rows))
    banded = whole.repartitionByRange(bands, F.desc("length2"), "vec_id").withColumn("band", F.spark_partition_id())
    banded = staged(banded, "bands")
    # Bands fall in length, so a query reaches the first few of them: the end is found by halving in the list of band maxima.
    most = banded.groupBy("band").agg(F.max("length2").alias("most"))
    most = most.agg(F.transform(F.array_sort(F.collect_list(F.struct("band", "most"))), lambda b: F.sqrt(b["most"]))).scalar()
    queries = queries.withColumn("reach", F.sqrt("length2"))

    def halved(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        near = F.col("reach") * F.get(F.col("most"), middle) * 1.000001 + 0.001 >= F.col("floor")
        step = F.struct(F.when(near, middle + 1).otherwise(s["low"]).alias("low"), F.when(near, s["high"]).otherwise(middle).alias("high"))
        return F.when(s["low"] < s["high"], step).otherwise(s)

    start = F.struct(F.lit(0).alias("low"), F.size("most").alias("high"))
    reached = F.aggregate(F.sequence(F.lit(0), F.lit(bands.bit_length())), start, halved)["low"]
    asked = queries.withColumn("most", most).withColumn("bands", reached).filter("bands > 0")
    # A task has one band and one block of queries; the band's vectors go to every block.
    blocks = max(1, -(-rows // every // query_rows))
    asked = asked.withColumn("band", F.explode(F.sequence(F.lit(0), F.col("bands") - 1)))
    asked = asked.withColumn("task", F.col("band") * F.lit(blocks).cast("long") + F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    vectors_ = banded.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    vectors_ = vectors_.withColumn("task", F.col("band") * F.lit(blocks).cast("long") + F.col("block"))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis = shared.value[2]
        band, held, ready = None, [], None
        for batch in batches:
            names = batch.column(0).to_numpy()
            floors = batch.column(3).to_numpy(zero_copy_only=False)
            keys, values = batch.column(1).to_numpy(), batch.column(2)
            cuts = np.flatnonzero((names[1:] != names[:-1]) | (np.isnan(floors[1:]) != np.isnan(floors[:-1]))) + 1
            for a, b in zip([0, *cuts], [*cuts, len(names)], strict=True):
                if a == b:
                    continue
                if names[a] != band:
                    band, held, ready = names[a], [], None
                part = matrix(values[a:b].to_pylist(), basis.shape[0])
                if np.isnan(floors[a]):  # vectors of the band come before its queries
                    held.append((keys[a:b], part))
                    continue
                if ready is None:
                    ids = np.concatenate([h[0] for h in held])
                    ready = Rotated(ids, np.concatenate([h[1] for h in held]), basis)
                found = ready.best(keys[a:b], part, basis, k, floors[a:b])
                scores = np.concatenate([s for _, s in found])
                over = (scores > LONGEST).astype(np.int32) - (scores < -LONGEST - 1).astype(np.int32)
                columns = [
                    pa.array(np.repeat(keys[a:b], [len(x) for x, _ in found])),
                    pa.array(np.concatenate([x for x, _ in found])),
                    pa.array(np.where(over == 0, scores, 0).astype(np.int64)),
                    pa.array(over),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score", "over"])

    rows_ = vectors_.select("task", "vec_id", "values", F.lit(float("nan")).alias("floor")).unionByName(
        asked.select("task", "vec_id", "values", "floor")
    )
    rows_ = rows_.repartition(bands * blocks, "task").sortWithinPartitions("task", F.isnan("floor").desc(), "vec_id")
    # over: 1 above and -1 below the longs; such scores only matter if they are among the k best.
    found = map_batches(rows_, search, "query_id long, vec_id long, score long, over int")
    order = Window.partitionBy("query_id").orderBy(F.desc("over"), F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    unfit = F.raise_error(F.concat(F.lit("score does not fit a long: query "), F.col("query_id").cast("string"))).cast("long")
    score = F.when(F.col("over") == 0, F.col("score")).otherwise(unfit)
    return ranked.select("query_id", "rank", "vec_id", score.alias("score"))
