"""Join shapes beyond a plain equi join.

No side is broadcast by hint: adaptive execution broadcasts a side whose measured size is under
the session's threshold and otherwise sorts, merges and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from stockwise.operators.windows import by


def later_day_sums(df: DataFrame, keys: Sequence[str], time: str, value: str, horizon: int) -> DataFrame:
    """For each day and each of the ``horizon`` rows from it on: the demand summed over the span.

    This stands for the join of a series with its own later days.  The sums are differences of one
    running total, gathered over a frame of ``horizon`` rows, so nothing is joined and a row fans
    out to at most ``horizon`` rows.
    """
    spec = by(keys, time)
    running = F.sum(value).over(spec.rowsBetween(Window.unboundedPreceding, 0))
    staged = df.withColumn("_sum", running)
    ahead = F.collect_list(F.struct(F.col(time).alias("predict_dt"), F.col("_sum").alias("_until"))).over(spec.rowsBetween(0, horizon - 1))
    spans = staged.withColumn("_ahead", ahead).select(
        *keys, time, (F.col("_sum") - F.col(value)).alias("_before"), F.inline("_ahead")
    )
    return spans.select(*keys, time, "predict_dt", (F.col("_until") - F.col("_before")).alias("cumsum"))


def outer_filled(left: DataFrame, right: DataFrame, keys: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Full outer join with missing numbers filled."""
    return left.join(right, list(keys), "full").na.fill(fill)
