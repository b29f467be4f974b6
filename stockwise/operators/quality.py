"""Data-quality checks and forecast monitors; each returns a report or alert table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stockwise.functions.numeric import half_even
from stockwise.operators.windows import by, top_rows


def invalid_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows in all and rows that meet each rule's bad condition, in one pass; one report row per rule."""
    counts = df.agg(F.count("*").alias("total"), *(F.count_if(bad).alias(f"bad_{name}") for name, bad in rules.items()))
    report = F.array(*(F.struct(F.lit(name).alias("rule"), F.col(f"bad_{name}").alias("bad")) for name in rules))
    rows = counts.select("total", F.inline(report))
    return rows.withColumn("passed", (F.col("total") > 0) & (F.col("bad") == 0))


class InvalidDataError(ValueError):
    """A checked table is empty or holds invalid values."""


def require_valid(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The table itself, or an error that names the broken rules."""
    broken = [row["rule"] for row in invalid_counts(df, rules).where(~F.col("passed")).collect()]
    if broken:
        raise InvalidDataError(f"invalid or missing rows: {', '.join(broken)}")
    return df


def forecast_comparison(new: DataFrame, online: DataFrame, history: DataFrame, days: int = 30) -> DataFrame:
    """Sums of the new and the online forecast per goods against the last day and the last days of history."""
    keys = ["wh_dept_id", "goods_id"]

    def summed(pred: DataFrame, out: str) -> DataFrame:
        first = top_rows(pred, keys, ["predict_dt"], days)
        return first.groupBy("goods_id").agg(half_even(F.sum("predict_demand"), 1).alias(out))

    last = history.select(F.max("ds")).scalar()
    recent = history.where(F.col("ds") > F.date_sub(last, days)).groupBy("goods_id").agg(
        F.sum(F.when(F.col("ds") == last, F.col("y"))).alias("lag_1"), F.sum("y").alias("lag_n")
    )
    joined = summed(new, "dmd_new").join(summed(online, "dmd_online"), "goods_id").join(recent, "goods_id")
    joined = joined.withColumn("lag_1_sum", F.col("lag_1") * days)
    return joined.select(
        "goods_id", "dmd_new", "dmd_online", "lag_1_sum", "lag_n",
        *(half_even(F.try_divide(F.col("dmd_new"), F.col(c)), 1).alias(n) for n, c in (("ratio", "dmd_online"), ("ratio_1", "lag_1_sum"), ("ratio_n", "lag_n"))),
    )


def spikes(features: DataFrame, factor: float = 2.0) -> DataFrame:
    """Days whose demand is at least ``factor`` times the day before or the mean of seven rows."""
    ratios = features.withColumns(
        {f"ratio_{n}": half_even(F.try_divide(F.col("y"), F.col(f"lag_{n}_mean")), 1) for n in (1, 7)}
    )
    return ratios.where((F.col("ratio_1") >= factor) | (F.col("ratio_7") >= factor))


def missing_members(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Expected keys that the data lacks."""
    return expected.select(*keys).distinct().join(actual, list(keys), "left_anti")


def history_and_forecast(history: DataFrame, forecast: DataFrame, days: int) -> DataFrame:
    """Trend table per goods: the last days of history and the forecast, one row per day and kind."""
    last = history.select(F.max("ds")).scalar()
    past = history.where(F.col("ds") > F.date_sub(last, days)).groupBy("goods_id", F.col("ds").alias("dt"))
    ahead = forecast.groupBy("goods_id", F.col("predict_dt").alias("dt"))
    return past.agg(F.sum("y").alias("amount")).withColumn("kind", F.lit("actual")).unionByName(
        ahead.agg(half_even(F.sum("pred"), 1).alias("amount")).withColumn("kind", F.lit("pred"))
    )


def row_count_ratio(df: DataFrame, time: str, low: float = 0.8, high: float = 1.5) -> DataFrame:
    """Rows per day against the day before it, with a label for missing and doubled data."""
    counts = df.groupBy(time).agg(F.count("*").alias("rows"))
    counts = counts.withColumn("rows_before", F.lag("rows").over(by([], time))).where(F.col("rows_before").isNotNull())
    ratio = F.col("rows") / F.col("rows_before")
    label = F.when(ratio < low, "low").when(ratio > high, "high").otherwise("ok")
    return counts.withColumns({"ratio": half_even(ratio, 4), "state": label})


def recent_launches(plan: DataFrame, commodity: str, launch: str, run_day: Column, days: int = 21, least_shops: int = 100) -> DataFrame:
    """Commodities whose last launch inside the open interval of ``days`` before the run day is wide enough: ``commodity, launch, shop_nums``.

    plan: one row per commodity and shop with its launch day.  Earlier launches of a commodity do not help a small last one.
    """
    inside = (F.col(launch) > F.date_sub(run_day, days)) & (F.col(launch) < run_day)
    shops = plan.where(inside).groupBy(commodity, launch).agg(F.count(F.lit(1)).alias("shop_nums"))
    last = shops.groupBy(commodity).agg(F.max(F.struct(launch, "shop_nums")).alias("_last"))
    return last.select(commodity, "_last.*").where(F.col("shop_nums") >= least_shops)
