"""Forecast accuracy: money conversion, metrics at several grains, accuracy marts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from stockwise.functions.numeric import band_label, half_even
from stockwise.operators.aggregate import median_day, multi_grain
from stockwise.operators.windows import by

# Fixed value: smallest denominator of the relative error (spacing of doubles at 1).
RELATIVE_FLOOR = 2.220446049250313e-16


def error_aggregates(actual: str, predicted: str, digits: int = 6) -> list[Column]:
    """MSE, MAE and MAPE as plain aggregates.

    Differences count to ``digits`` decimals and are summed as whole decimals of the last one, which keeps
    the sums exact and so independent of the order in which tasks finish.
    """
    unit = 10.0**digits
    diff = F.col(predicted) - F.col(actual)
    whole = F.rint(F.abs(diff) * unit).cast("decimal(19,0)")
    n = F.count(whole)
    relative = F.abs(diff) / F.greatest(F.abs(F.col(actual)), F.lit(RELATIVE_FLOOR))
    return [
        half_even(F.sum(whole * whole).cast("double") / n / (unit * unit), 4).alias("MSE"),
        half_even(F.sum(whole).cast("double") / n / unit, 4).alias("MAE"),
        half_even(F.avg(relative), 4).alias("MAPE"),
    ]


def accuracy_metrics(
    df: DataFrame, common: Sequence[str], grains: Mapping[str, Sequence[str]], actual: str, predicted: str, digits: int = 6
) -> DataFrame:
    """Error metrics per ``common`` columns at every grain, in one pass with grouping sets."""
    metrics = multi_grain(df, common, grains, error_aggregates(actual, predicted, digits))
    return metrics.withColumn("ACC", half_even(1 - F.col("MAPE"), 4))


def with_price(df: DataFrame, price: DataFrame) -> DataFrame:
    """Unit price of every row: of its warehouse and goods, else the goods mean, else the warehouse mean.

    The price tables hold one row per pair, goods and warehouse; adaptive execution broadcasts
    those that are small, so the wide side is shuffled once at most.
    """
    keys = ["wh_dept_id", "goods_id"]
    own = price.select(*keys, F.col("unit_price").alias("_own"))
    goods = price.groupBy("goods_id").agg(half_even(F.avg("unit_price"), 4).alias("_goods"))
    wh = price.groupBy("wh_dept_id").agg(half_even(F.avg("unit_price"), 4).alias("_wh"))
    found = df.join(own, keys, "left").join(goods, "goods_id", "left").join(wh, "wh_dept_id", "left")
    return found.withColumn("unit_price", F.coalesce("_own", "_goods", "_wh")).drop("_own", "_goods", "_wh")


def to_money(df: DataFrame, price: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Quantities as money, rounded to one digit."""
    return with_price(df, price).withColumns(
        {
            "y_price": half_even(F.col(actual) * F.col("unit_price"), 1),
            "pred_price": half_even(F.col(predicted) * F.col("unit_price"), 1),
        }
    )


def horizon_totals(df: DataFrame, keys: Sequence[str], actual: str, predicted: str) -> DataFrame:
    """Actual and predicted sums over the horizon."""
    return df.groupBy(*keys).agg(
        half_even(F.sum(actual), 1).alias(actual), half_even(F.sum(predicted), 1).alias(predicted)
    )


def backtest_errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Row-wise APE, AE, SE and accuracy floored at zero; no actual means no relative error."""
    diff = F.col(predicted) - F.col(actual)
    mape = F.abs(F.try_divide(diff, F.col(actual)))
    return df.withColumns(
        {
            "MAPE": half_even(mape, 6),
            "MAE": half_even(F.abs(diff), 4),
            "MSE": half_even(diff * diff, 2),
            "ACC": half_even(F.when(mape > 1, 0.0).otherwise(1 - mape), 6),
        }
    )


def recent_accuracy(df: DataFrame, keys: Sequence[str], time: str, months: Sequence[int]) -> DataFrame:
    """Means of the metrics, and deviation of the accuracy, over the last ``n`` evaluations.

    The metrics have four digits; averaging them as whole ten-thousandths keeps the sums exact.
    """
    scaled = {m: F.rint(F.col(m) * 1e4) for m in ("MSE", "MAE", "MAPE", "ACC")}
    columns: dict[str, Column] = {}
    for n in months:
        frame = by(keys, time).rowsBetween(-(n - 1), 0)
        for metric, value in scaled.items():
            columns[f"last_{n}_{metric.lower()}"] = half_even(F.avg(value).over(frame)) / 1e4
        columns[f"last_{n}_std"] = half_even(F.stddev_samp(scaled["ACC"]).over(frame)) / 1e4
    return df.withColumns(columns)


def consumption_mart(
    sources: Sequence[tuple[DataFrame, DataFrame]], keys: Sequence[str], value: str, start: str, end: str
) -> DataFrame:
    """Sum each source over the days for the goods on its own list, then put the sources together."""
    parts = []
    for rows, goods in sources:
        span = rows.where(F.col("ds").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
        summed = span.dropna(subset=["goods_id"]).groupBy(*keys).agg(F.sum(value).alias("real_consume"))
        parts.append(summed.join(goods.select("goods_id", "large_class_name").distinct(), "goods_id"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def lifecycle_class(plan: DataFrame, keys: Sequence[str], run_day: str) -> DataFrame:
    """Class of a commodity from its median dates: normal, new, or subnew within 21 days of its start."""
    day = F.lit(run_day).cast("timestamp")
    since = F.lit(run_day).cast("timestamp") - F.expr("interval 21 days")
    medians = plan.groupBy(*keys).agg(*(median_day(c).alias(c) for c in ("launch_date", "sale_date", "actual_launch_date")))
    fresh = [(F.col(c) > since) & (F.col(c) <= day) for c in ("sale_date", "actual_launch_date")]
    label = (
        F.when(fresh[0] | fresh[1], "subnew")
        .when((F.col("launch_date") > day) & F.col("sale_date").isNull(), "new")
        .otherwise("norm")
    )
    return medians.withColumn("cmdty_type", label)


@dataclass(frozen=True)
class Span:
    """A trailing window of days and the day before it, whose forecast it is compared with."""

    days: int
    start: date
    end: date
    run_dt: date


def spans_of(run_day: str, lengths: Sequence[int]) -> list[Span]:
    day = date.fromisoformat(run_day)
    return [Span(n, day - timedelta(n), day - timedelta(1), day - timedelta(n + 1)) for n in lengths]


def in_spans(df: DataFrame, day: str, spans: Sequence[Span], run_dt: str | None = None) -> DataFrame:
    """Every row once per span that holds its day (and, for forecasts, matches its run day).

    The outer bounds are a plain filter, which reaches the scan and prunes partitions.
    """
    rows = df.where(F.col(day).between(F.lit(min(s.start for s in spans)), F.lit(max(s.end for s in spans))))

    def held(span: Span) -> Column:
        inside = F.col(day).between(F.lit(span.start), F.lit(span.end))
        if run_dt is not None:
            inside = inside & (F.col(run_dt) == F.lit(span.run_dt))
        return F.when(inside, F.struct(F.lit(span.days).alias("days"), F.lit(span.run_dt).alias("run_dt")))

    picked = rows.withColumn("_span", F.explode(F.array_compact(F.array(*(held(s) for s in spans)))))
    return picked.withColumns({"days": F.col("_span.days"), "run_dt": F.col("_span.run_dt")}).drop("_span")


def accuracy_fact(
    predicted: DataFrame,
    consumed: DataFrame,
    norm_share: DataFrame,
    price: DataFrame,
    goods: DataFrame,
    slow: DataFrame,
    span: Sequence[str],
) -> DataFrame:
    """Predicted against real consumption per window, warehouse and goods, in pieces and money.

    ``predicted`` holds ``all_pred`` and ``common_pred``, ``consumed`` the real consumption and
    ``norm_share`` the share of normal commodities in it.  All sides are aggregated beforehand.
    """
    keys = ["wh_dept_id", "goods_id"]
    fact = predicted.join(consumed, [*span, *keys]).na.fill(0.0, ["all_pred", "common_pred", "real_consume"])
    fact = fact.join(price, keys, "left").join(goods, "goods_id", "left").join(norm_share, [*span, *keys], "left")
    no_common = (F.col("all_pred") > 0) & (F.col("common_pred") == 0)
    fact = fact.withColumn("common_ratio", F.coalesce(F.when(no_common, 0.0).otherwise(F.col("common_ratio")), F.lit(1.0)))
    fact = fact.withColumn("common_consume", half_even(F.col("real_consume") * F.col("common_ratio"), 2))
    amounts = {
        "all_consume_amount": "real_consume",
        "common_consume_amount": "common_consume",
        "common_predict_amount": "common_pred",
        "all_predict_amount": "all_pred",
    }
    fact = fact.withColumns({out: half_even(F.col(c) * F.col("unit_price"), 2) for out, c in amounts.items()})
    fact = fact.withColumns({f"diff_{k}": F.col(f"{k}_predict_amount") - F.col(f"{k}_consume_amount") for k in ("common", "all")})
    fact = fact.withColumns(
        {f"abs_diff_{k}": F.abs(F.col(f"diff_{k}")) for k in ("common", "all")}
        | {f"sq_diff_{k}": F.col(f"diff_{k}") * F.col(f"diff_{k}") for k in ("common", "all")}
        | {
            "MPE_common": half_even(F.try_divide(F.col("common_pred") - F.col("common_consume"), F.col("common_consume")), 2),
            "MPE_all": half_even(F.try_divide(F.col("diff_all"), F.col("all_consume_amount")), 2),
        }
    )
    fact = fact.withColumns({f"MAPE_{k}": F.abs(F.col(f"MPE_{k}")) for k in ("common", "all")})
    fact = fact.join(slow.select("goods_id", F.lit(1).cast("long").alias("is_longtail")), "goods_id", "left")
    return fact.withColumn("is_longtail", F.coalesce(F.col("is_longtail"), F.lit(0).cast("long")))


def slow_goods(classes: DataFrame, slow_types: Sequence[str], more_than: int) -> DataFrame:
    """Goods that belong to a slow class in more than ``more_than`` warehouses."""
    slow = classes.where(F.col("dly_model_type").isin(*slow_types))
    counted = slow.groupBy("goods_id").agg(F.count("wh_dept_id").alias("wh_cnt"))
    return counted.where(F.col("wh_cnt") > more_than)


def accuracy_by_grain(fact: DataFrame, span: Sequence[str], without_classes: Sequence[str] = ()) -> DataFrame:
    """MAPE, MSE, RMSE and MAE per goods, class and in total, with and without long-tail goods.

    One scan: grouping sets give the grains, conditional sums the twin without the long tail.  Classes in
    ``without_classes`` count nowhere.
    """
    priced = fact.where(F.col("unit_price").isNotNull())
    if without_classes:
        priced = priced.where(~F.coalesce(F.col("large_class_name").isin(*without_classes), F.lit(False)))
    short = F.col("is_longtail") == 0
    grains = {"goods": ["large_class_name", "goods_id"], "class": ["large_class_name"], "all": []}
    measures: list[Column] = [F.median("is_longtail").alias("longtail_median")]
    def cents(value: Column) -> Column:
        """Amounts have two digits; summing whole cents keeps the sums exact."""
        return F.sum(F.rint(value * 100)) / 100

    for suffix, keep in (("", F.lit(True)), ("_nolongtail", short)):
        measures.append(F.sum(F.when(keep, 1.0)).alias(f"n{suffix}"))
        for k in ("common", "all"):
            for m in (f"abs_diff_{k}", f"{k}_consume_amount"):
                measures.append(cents(F.when(keep, F.col(m))).alias(f"{m}{suffix}"))
            whole = F.rint(F.col(f"diff_{k}") * 100).cast("decimal(19,0)")
            measures.append((F.sum(F.when(keep, whole * whole)).cast("double") / 1e4).alias(f"sq_diff_{k}{suffix}"))
    sums = multi_grain(priced, span, grains, measures)
    columns: dict[str, Column] = {"is_longtail": (F.col("longtail_median") > 0.5).cast("long")}
    for suffix in ("", "_nolongtail"):
        n = F.col(f"n{suffix}")
        for k in ("common", "all"):
            absolute, square = F.col(f"abs_diff_{k}{suffix}"), F.col(f"sq_diff_{k}{suffix}")
            consumed = F.col(f"{k}_consume_amount{suffix}")
            ratio = F.when(consumed > 0, absolute / consumed)
            columns |= {
                f"mape_{k}{suffix}": half_even(F.coalesce(ratio, F.lit(0.0)), 6),
                f"mse_{k}{suffix}": half_even(square / n, 4),
                f"rmse_{k}{suffix}": half_even(F.sqrt(square / n), 3),
                f"mae_{k}{suffix}": half_even(absolute / n, 3),
            }
    kept = [*span, "large_class_name", "goods_id", "grain"]
    return sums.select(*kept, *(c.alias(name) for name, c in columns.items()))


def bad_cases(fact: DataFrame, error: str, threshold: float) -> DataFrame:
    """Rows above the error threshold with their band and the rounded difference."""
    bad = fact.where(F.col(error) > threshold)
    return bad.withColumns(
        {
            "accuracy_label": band_label(F.col(error)),
            "diff": half_even(F.col("pred") - F.col("y"), 1),
            "wh_goods": F.concat_ws("_", "wh_name", "goods_name"),
        }
    )
