"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents of one length are interchangeable, so best fit runs over the histogram of lengths, which has at most as
many entries as the longest permitted sequence has tokens, however many documents there are.  It yields runs: "from
rank a on, the documents of length l go k to a bin, from bin b on".  Ranks within a length come from prefix
sums over small cells, so no task ever holds all documents of a length.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from stockwise.session import staged

CAPACITIES = (2048, 4096, 8192, 16384, 32768)


def sequence_cost(capacity: int) -> float:
    """Linear work per token plus attention, which grows with the square."""
    return capacity + capacity * capacity / 131072


@dataclass
class Plan:
    """runs: (length, first rank, ranks, first bin, per bin, offset); bins: (first bin, bins, used, capacity)."""

    cost: float = 0.0
    n_bins: int = 0
    runs: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    bins: list[tuple[int, int, int, int]] = field(default_factory=list)


def best_fit(
    counts: dict[int, int], capacities: Sequence[int], cost: Callable[[int], float], opening: int | None = None
) -> Plan:
    """Best fit by descending length over a histogram; every length is at most the largest capacity.

    A bin is opened at the size of least cost per token that the remaining documents can put into it (at
    least at ``opening``, if given); at the end each bin shrinks to the smallest size that holds its contents.
    """
    capacities = sorted(capacities)
    plan, open_bins = Plan(), []  # open_bins: (residual, first bin, bins, used), by residual
    left = sum(length * n for length, n in counts.items())

    def put(residual: int, first: int, bins: int, used: int) -> None:
        if bins:
            insort(open_bins, (residual, first, bins, used))

    for length in sorted(counts, reverse=True):
        n, rank = counts[length], 0
        while n:
            at = bisect_left(open_bins, (length,))
            if at < len(open_bins):
                residual, first, bins, used = open_bins.pop(at)
                per = residual // length
            else:
                fits = [c for c in capacities if c >= max(length, opening or 0)] or [capacities[-1]]
                size = min(fits, key=lambda c: (cost(c) / min(c, left), c))
                per, residual, used, first = size // length, size, 0, plan.n_bins
                bins = -(-n // per)
                plan.n_bins += bins
            taken = min(n, bins * per)
            full, rest = divmod(taken, per)
            plan.runs.append((length, rank, taken, first, per, used))
            put(residual - per * length, first, full, used + per * length)
            if rest:
                put(residual - rest * length, first + full, 1, used + rest * length)
            put(residual, first + full + (rest > 0), bins - full - (rest > 0), used)
            n, rank, left = n - taken, rank + taken, left - taken * length
    for _, first, bins, used in open_bins:
        size = next(c for c in capacities if c >= used)
        plan.bins.append((first, bins, used, size))
        plan.cost += bins * cost(size)
    return plan


def joint_plan(counts: dict[int, int], capacities: Sequence[int], cost: Callable[[int], float]) -> Plan:
    """The cheapest plan over all opening sizes."""
    return min((best_fit(counts, capacities, cost, c) for c in (None, *sorted(capacities))), key=lambda p: p.cost)


def sized_runs(plan: Plan) -> list[tuple[int, int, int, int, int, int, int]]:
    """The runs, cut where the final size of the bins changes: (length, ranks from, to, first bin, per bin, offset, size)."""
    groups = sorted(plan.bins)
    starts = [g[0] for g in groups]
    out = []
    for length, rank, taken, first, per, used in plan.runs:
        last = first + -(-taken // per)
        at = bisect_right(starts, first) - 1
        while at < len(groups) and groups[at][0] < last:
            start, n, _, size = groups[at]
            a, b = max(first, start), min(last, start + n)
            out.append(
                (length, rank + (a - first) * per, rank + min(taken, (b - first) * per), a, per, used, size)
            )
            at += 1
    return out


def cell_ranks(rows: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Adds ``rank``: the running sum of ``weight`` before each row among the rows of its ``keys`` (of all rows, without keys).

    rows: with ``__cells``, over how many cells the rows of their key are dealt by a hash of the id.  Rows move by key and cell, so
    that a frequent key fills many tasks; a window holds one cell, and the cells' bases are prefix sums over one row per cell.
    """
    dealt = rows.withColumn("__cell", F.pmod(F.xxhash64("doc_id"), F.col("__cells"))).drop("__cells")
    cells = dealt.groupBy(*keys, "__cell").agg(F.sum(weight).alias("__sum"))
    before = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(*keys, "__cell", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    own = Window.partitionBy(*keys, "__cell").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.withColumn("rank", F.coalesce(F.sum(weight).over(own), F.lit(0)))
    return ranked.join(cells, [*keys, "__cell"]).withColumn("rank", F.col("rank") + F.col("__base"))


def pack(
    lengths: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
    cell_rows: int = 50_000,
) -> DataFrame:
    """One row per piece of a document: ``doc_id, piece, n_tokens, bin_id, capacity, bin_offset``.

    lengths: ``doc_id, n_tokens``.  A document longer than the largest capacity fills whole bins of that size and its
    remainder is packed like any other document.  ``bin_offset`` is the place of the piece in its bin.

    Defined cases: null or non-positive lengths give no row (nothing to place).  Null ids and repeated rows are
    placed like any other row.  An empty table gives no rows.  Other columns are not read.
    """
    spark, largest = lengths.sparkSession, max(capacities)
    rows = lengths.filter(F.col("n_tokens") > 0).select(
        "doc_id",
        F.floor(F.col("n_tokens") / largest).alias("whole"),
        (F.col("n_tokens") % largest).cast("long").alias("tail"),
    )
    rows = staged(rows, "lengths")
    # One number per length below the largest capacity.
    counts = {r[0]: r[1] for r in rows.filter("tail > 0").groupBy("tail").count().collect()}
    plan = joint_plan(counts, capacities, cost)
    cells = spark.createDataFrame([(k, -(-n // cell_rows)) for k, n in counts.items()], "tail long, __cells long")

    # The runs' number is bounded by the largest capacity, not by the documents: a fill at least halves a residual.
    runs = spark.createDataFrame(
        sized_runs(plan),
        "tail long, from_rank long, to_rank long, first_bin long, per_bin long, used long, capacity int",
    )
    tails = rows.filter("tail > 0").select("doc_id", "whole", "tail", F.lit(1).cast("long").alias("one"))
    tails = cell_ranks(tails.join(F.broadcast(cells), "tail"), ["tail"], "one").join(F.broadcast(runs), "tail")
    tails = tails.filter((F.col("rank") >= F.col("from_rank")) & (F.col("rank") < F.col("to_rank")))
    step = F.col("rank") - F.col("from_rank")
    tails = tails.select(
        "doc_id",
        F.col("whole").alias("piece"),
        F.col("tail").alias("n_tokens"),
        (F.col("first_bin") + F.floor(step / F.col("per_bin"))).alias("bin_id"),
        "capacity",
        (F.col("used") + (step % F.col("per_bin")) * F.col("tail")).alias("bin_offset"),
    )
    long = rows.filter("whole > 0").select("doc_id", "whole")
    long = long.withColumn("__cells", F.lit(max(1, -(-long.count() // cell_rows))))
    long = cell_ranks(long, [], "whole").withColumn("piece", F.explode(F.expr("sequence(0L, whole - 1)")))
    long = long.select(
        "doc_id",
        "piece",
        F.lit(largest).cast("long").alias("n_tokens"),
        (F.lit(plan.n_bins) + F.col("rank") + F.col("piece")).alias("bin_id"),
        F.lit(largest).cast("int").alias("capacity"),
        F.lit(0).cast("long").alias("bin_offset"),
    )
    return tails.unionByName(long)


def byte_lengths(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` for a byte-level vocabulary: the UTF-8 bytes and an end mark; null counts as empty."""
    n = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long") + 1
    return docs.select(F.col(id_col).alias("doc_id"), n.alias("n_tokens"))
