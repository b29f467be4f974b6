"""Choosing and combining models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stockwise.functions.numeric import half_even
from stockwise.operators.windows import best_rows, last_rows, previous_value


def latest_best_model(recent: DataFrame, keys: Sequence[str], time: str, score: str, ties: str = "first") -> DataFrame:
    """Best model per key by the newest score of each model.

    With ``ties="all"`` every model that shares the top score stays, and a later sum over
    forecasts would count the key more than once.
    """
    newest = last_rows(recent, [*keys, "model"], time)
    return best_rows(newest, keys, score, "model", ties).select(*keys, "model", score)


def previous_best_model(recent: DataFrame, keys: Sequence[str], time: str, score: str) -> DataFrame:
    """For every evaluation date the model that was best on the date before."""
    best = best_rows(recent, [*keys, time], score, "model")
    return previous_value(best, keys, time, "model", "best_model").select(*keys, time, score, "best_model")


def mixed_forecast(forecast: DataFrame, best: DataFrame, on: Sequence[str]) -> DataFrame:
    """Forecast rows of the chosen model."""
    return forecast.join(best.select(*on, "model"), [*on, "model"])


def combine_populations(forecast: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Normal demand is the sum over normal and new shops; for the total the largest group counts."""
    normal = forecast.where(F.col("data_label").isin("normal", "new_shop_normal"))
    total = forecast.where(F.col("data_label") == "all")
    summed = normal.groupBy(*keys).agg(half_even(F.sum(value), 1).alias("demand")).withColumn("kind", F.lit("normal"))
    largest = total.groupBy(*keys).agg(half_even(F.max(value), 1).alias("demand")).withColumn("kind", F.lit("all"))
    return summed.unionByName(largest)


def weighted_ensemble(forecast: DataFrame, accuracy: DataFrame, keys: Sequence[str], score: str, value: str) -> DataFrame:
    """Forecasts summed with each model's share of the accuracy of its key; no accuracy, no weight."""
    totals = accuracy.groupBy(*keys).agg(F.sum(score).alias("_total"))
    weights = accuracy.join(totals, list(keys)).withColumn("weight", F.try_divide(F.col(score), F.col("_total")))
    weighted = forecast.join(weights.select(*keys, "model", "weight"), [*keys, "model"], "left")
    share = F.col(value) * F.coalesce(F.col("weight"), F.lit(0.0))
    return weighted.groupBy(*keys, "predict_dt").agg(F.sum(share).alias(value))


def negative_forecasts(forecast: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Keys and models with any forecast below zero, to be excluded by an anti join."""
    return forecast.where(F.col(value) < 0).select(*keys, "model").distinct()
