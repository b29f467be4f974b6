"""Aggregations over several grains, shares, medians, bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stockwise.functions.numeric import BAND_LABELS, band_flags, half_even
from stockwise.operators.windows import share_of_total


def multi_grain(
    df: DataFrame, common: Sequence[str], grains: Mapping[str, Sequence[str]], measures: Sequence[Column]
) -> DataFrame:
    """The same measures at every grain in one scan with grouping sets.

    ``grains`` maps a grain's name to the columns it keeps besides ``common``.
    """
    extra = list(dict.fromkeys(c for g in grains.values() for c in g))
    sets = [[F.col(c) for c in (*common, *g)] for g in grains.values()]
    name = None
    for grain, kept in grains.items():
        match = F.lit(True)
        for c in extra:
            match = match & (F.grouping(c) == (0 if c in kept else 1))
        name = F.when(match, grain) if name is None else name.when(match, grain)
    return df.groupingSets(sets, *common, *extra).agg(name.alias("grain"), *measures)


def band_ratios(
    df: DataFrame, common: Sequence[str], grains: Mapping[str, Sequence[str]], error: Column, digits: int = 4
) -> DataFrame:
    """Counts of rows per error band, their total and their shares, per grain."""
    flagged = df.withColumns(band_flags(error))
    counted = multi_grain(
        flagged, common, grains, [F.count("*").alias("total"), *(F.sum(b).alias(b) for b in BAND_LABELS)]
    )
    return counted.withColumns({f"{b}_ratio": half_even(F.col(b) / F.col("total"), digits) for b in BAND_LABELS})


def median_day(day: str) -> Column:
    """Median of a date column as a timestamp (the middle of two days may fall on noon).

    The state is one counter per distinct day and is combined on the map side.
    """
    return F.timestamp_seconds(F.median(F.unix_timestamp(F.col(day).cast("timestamp"))).cast("double"))


def weighted_price(
    df: DataFrame, keys: Sequence[str], money: str, count: str, time: str, run_day: Column, days: int
) -> DataFrame:
    """Money per piece over the trailing days, of rows with a positive count."""
    recent = df.where((F.col(time) >= F.date_sub(run_day, days)) & (F.col(count) > 0))
    return recent.groupBy(*keys).agg((F.sum(money) / F.sum(count)).alias("unit_price"))


def cost_shares(df: DataFrame, group: Sequence[str], part: str, cost: str, digits: int = 2) -> DataFrame:
    """Cost of each part (commodity or type) of a group and its rounded share of the group's cost."""
    parts = df.groupBy(*group, part).agg(F.sum(F.coalesce(F.col(cost), F.lit(0.0))).alias("part_cost"))
    shared = share_of_total(parts, group, "part_cost", "group_cost", "ratio")
    return shared.withColumn("ratio", F.coalesce(half_even(F.col("ratio"), digits), F.lit(0.0)))


def pivot_labels(df: DataFrame, keys: Sequence[str], label: str, labels: Sequence[str], measure: Column) -> DataFrame:
    """One column per label; the labels are given, so no extra pass looks for them."""
    return df.groupBy(*keys).pivot(label, list(labels)).agg(measure)
