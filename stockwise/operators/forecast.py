"""Forecasts that need no fitted model object: baselines, trend and season, ordered folds.

A fold takes the ordered history of one key as an array.  The history has one value per day, so
the array is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from stockwise.functions.dates import date_parts, days_from
from stockwise.functions.numeric import at_least, half_even
from stockwise.operators.accuracy import RELATIVE_FLOOR


def flat_baselines(
    df: DataFrame, keys: Sequence[str], time: str, windows: Sequence[int], horizon: int, origin: Column | None = None
) -> DataFrame:
    """Hold the lagged means of every origin day flat over the horizon, one model per window.

    Origins are month starts unless a condition says otherwise.
    """
    models = F.array(
        *(F.struct(F.lit(f"window_{w}").alias("model"), F.col(f"lag_{w}_mean").alias("pred")) for w in windows)
    )
    starts = df.where(F.dayofmonth(time) == 1 if origin is None else origin)
    origins = starts.select(*keys, F.col(time).alias("dt"), F.inline(models))
    return origins.where(F.col("pred").isNotNull()).select(
        "model",
        "dt",
        F.explode(days_from(F.col("dt"), horizon)).alias("predict_dt"),
        *keys,
        F.col("pred").alias("predict_demand"),
    )


def dense_horizon(forecast: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every day of every horizon with its date parts, the actual value where there is one."""
    joined = forecast.join(actual, [*keys, "predict_dt"], "left")
    return joined.withColumns(date_parts(F.col("predict_dt")))


def clipped_sums(forecast: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Forecasts floored at zero, summed over the horizon and rounded to one digit."""
    return forecast.groupBy(*keys).agg(half_even(F.sum(at_least(F.col(value))), 1).alias(value))


def history_arrays(df: DataFrame, keys: Sequence[str], time: str, value: str) -> DataFrame:
    """One row per key: the last day and the values in time order."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(time).alias("t"), F.col(value).alias("v"))))
    return df.groupBy(*keys).agg(F.max(time).alias("last_day"), ordered.alias("_rows")).select(
        *keys, "last_day", F.transform("_rows", lambda r: r["v"]).alias("history")
    )


def tail(values: Column, n: int) -> Column:
    """The last ``n`` elements, fewer where the array is shorter."""
    size = F.size(values)
    return F.slice(values, F.greatest(size - n + 1, F.lit(1)), F.lit(n))


def array_mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(values).cast("double"))


def explode_steps(df: DataFrame, keys: Sequence[str], steps: str, out: str) -> DataFrame:
    """Array of forecasts per key to one row per day after ``last_day``."""
    return df.select(*keys, "last_day", F.posexplode(steps).alias("_step", out)).select(
        *keys, F.date_add("last_day", F.col("_step") + 1).alias("predict_dt"), out
    )


def recursive_mean(
    df: DataFrame, keys: Sequence[str], time: str, value: str, horizon: int, window: int = 7
) -> DataFrame:
    """Recursive forecast whose model is the mean of the last ``window`` values.

    Each step rounds to one digit and feeds the next; negative values are floored only afterwards.
    """
    histories = history_arrays(df, keys, time, value).withColumn("history", tail(F.col("history"), window))
    start = F.size("history")
    grown = F.aggregate(
        F.sequence(F.lit(1), F.lit(horizon)),
        F.col("history"),
        lambda held, _: F.concat(held, F.array(half_even(array_mean(tail(held, window)), 1))),
    )
    steps = histories.withColumn("_steps", F.slice(grown, start + 1, F.lit(horizon)))
    return explode_steps(steps, keys, "_steps", "pred").withColumn("pred", at_least(F.col("pred")))


TRAIN_DAYS = (60, 90, 180)


def trend_season(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    last_origin: Column,
    train_days: Sequence[int] = TRAIN_DAYS,
    horizon: int = 30,
    bounded: bool = True,
) -> DataFrame:
    """Linear trend plus weekday effect per key, month-start origin and training length.

    A row is sent to every origin whose training window holds it; the sums a least-squares line
    needs are combined on the map side, per weekday, so each group shuffles at most seven rows.
    The forecast stays between the smallest and the largest training value.
    """
    day = F.col(time)
    first = F.add_months(F.trunc(day, "month"), 1)

    def origins(days: int) -> Column:
        last = F.least(F.trunc(F.date_add(day, days), "month"), F.col("_last"))
        starts = F.when(last >= first, F.sequence(first, last, F.expr("interval 1 month")))
        return F.transform(
            F.coalesce(starts, F.array().cast("array<date>")),
            lambda o: F.struct(o.alias("dt"), F.lit(days).alias("train_size")),
        )

    bounded_rows = df.withColumn("_last", last_origin)
    rows = bounded_rows.select(*keys, time, value, F.inline(F.flatten(F.array(*(origins(d) for d in train_days)))))
    x = F.date_diff(day, F.col("dt")).cast("double")
    y = F.col(value)
    group = [*keys, "dt", "train_size"]
    moments = rows.groupBy(*group, F.weekday(day).alias("dow")).agg(
        F.count("*").cast("double").alias("n"),
        F.sum(x).alias("sx"),
        F.sum(y).alias("sy"),
        F.sum(x * x).alias("sxx"),
        F.sum(x * y).alias("sxy"),
        F.min(y).alias("low"),
        F.max(y).alias("high"),
    )
    week = F.map_from_entries(F.collect_list(F.struct("dow", F.struct("n", "sx", "sy"))))
    fits = moments.groupBy(*group).agg(
        *(F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        week.alias("week"),
    ).where(F.col("n") >= 2)
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    slope = F.try_divide(n * F.col("sxy") - sx * sy, n * F.col("sxx") - sx * sx)
    fits = fits.withColumn("slope", F.coalesce(slope, F.lit(0.0)))
    fits = fits.withColumn("base", (sy - F.col("slope") * sx) / n)
    steps = fits.withColumn("predict_dt", F.explode(days_from(F.col("dt"), horizon)))
    ahead = F.date_diff("predict_dt", "dt").cast("double")
    same = F.col("week")[F.weekday("predict_dt")]
    effect = same["sy"] / same["n"] - (F.col("base") + F.col("slope") * same["sx"] / same["n"])
    pred = F.col("base") + F.col("slope") * ahead + F.coalesce(effect, F.lit(0.0))
    if bounded:
        pred = F.least(F.greatest(pred, F.col("low")), F.col("high"))
    return steps.select(*group, "predict_dt", pred.alias("pred"))


#: Solution of the normal equations of ``a + b x + d h`` (h: the days after a knot) by Cramer's rule, as SQL over their sums.
BEND = {
    "det": "n * (sxx * shh - sxh * sxh) - sx * (sx * shh - sxh * sh) + sh * (sx * sxh - sxx * sh)",
    "base": "(sy * (sxx * shh - sxh * sxh) - sx * (sxy * shh - sxh * syh) + sh * (sxy * sxh - sxx * syh)) / det",
    "slope": "(n * (sxy * shh - syh * sxh) - sy * (sx * shh - sxh * sh) + sh * (sx * syh - sxy * sh)) / det",
    "bend": "(n * (sxx * syh - sxh * sxy) - sx * (sx * syh - sxy * sh) + sy * (sx * sxh - sxx * sh)) / det",
    "error": "syy - base * sy - slope * sxy - bend * syh",
}


def bent_trend(
    df: DataFrame, keys: Sequence[str], time: str, value: str, first: Column, last: Column, knots: int = 9, least_gain: float = 0.1
) -> DataFrame:
    """Piecewise-linear trend with one change of slope per key: ``keys, first_day, knot, base, slope, bend``, 0 as bend without a change.

    Candidate knots divide the days from ``first`` to ``last`` (columns of the keys) evenly.  One pass sums what the normal equations of all
    candidates need, combined on the map side, so a key's rows are never gathered; the knot with the least squared error wins, the
    earliest of equals, if it takes off at least ``least_gain`` of the error of a straight line.  ``base`` is the level on the first day, ``slope``
    and ``slope + bend`` the change per day before and after the knot.  Keys with fewer than four rows give nothing.
    """
    x, y = F.col("_x"), F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull()).withColumns(
        {"_first": first, "_x": F.date_diff(time, first).cast("double"), "_span": F.date_diff(last, first)}
    )

    def knot(j: int) -> Column:
        return F.floor(F.col("_span") * j / (knots + 1)).cast("double")

    sums = [F.count(F.lit(1)).cast("double").alias("n"), F.sum(x).alias("sx"), F.sum(x * x).alias("sxx")]
    sums += [F.sum(y).alias("sy"), F.sum(x * y).alias("sxy"), F.sum(y * y).alias("syy")]
    bent = []
    for j in range(1, knots + 1):
        h = F.greatest(x - knot(j), F.lit(0.0))
        parts = {"sh": h, "sxh": x * h, "shh": h * h, "syh": y * h}
        sums += [F.max(knot(j)).alias(f"_at{j}"), *(F.sum(c).alias(f"_{name}{j}") for name, c in parts.items())]
        bent.append(F.struct(F.col(f"_at{j}").alias("at"), *(F.col(f"_{name}{j}").alias(name) for name in parts)))
    moments = rows.groupBy(*keys, "_first").agg(*sums).where(F.col("n") >= 4)
    moments = moments.withColumn("_det", F.expr("n * sxx - sx * sx")).withColumn("_slope", F.coalesce(F.expr("try_divide(n * sxy - sx * sy, _det)"), F.lit(0.0)))
    moments = moments.withColumn("_base", F.expr("(sy - _slope * sx) / n")).withColumn("_error", F.expr("syy - _base * sy - _slope * sxy"))
    tried = moments.select("*", F.inline(F.array(*bent))).withColumn("det", F.expr(BEND["det"])).where(F.col("det") > 0)
    for name in ("base", "slope", "bend", "error"):
        tried = tried.withColumn(name, F.expr(BEND[name]))
    best = tried.groupBy(*keys).agg(F.min(F.struct("error", "at", "base", "slope", "bend")).alias("_best"))
    found = moments.select(*keys, "_first", "_base", "_slope", "_error", "syy").join(best, list(keys), "left")
    # An error within the rounding of the sums is none that a knot could take off.
    real = F.col("_error") > F.col("syy") * 1e-9
    changed = F.coalesce(real & (F.col("_best.error") <= F.col("_error") * (1 - least_gain)), F.lit(False))

    def chosen(name: str, plain: Column) -> Column:
        return F.when(changed, F.col(f"_best.{name}")).otherwise(plain).alias(name)

    at = F.when(changed, F.date_add("_first", F.col("_best.at").cast("int"))).alias("knot")
    return found.select(*keys, F.col("_first").alias("first_day"), at, chosen("base", F.col("_base")), chosen("slope", F.col("_slope")), chosen("bend", F.lit(0.0)))


def bent_forecast(trends: DataFrame, keys: Sequence[str], start: Column, horizon: int) -> DataFrame:
    """The trends of :func:`bent_trend` carried on over ``horizon`` days from ``start``: ``keys, predict_dt, pred``, not below zero."""
    days = trends.withColumn("predict_dt", F.explode(days_from(start, horizon)))
    after = F.coalesce(F.greatest(F.date_diff("predict_dt", "knot"), F.lit(0)), F.lit(0))
    pred = F.col("base") + F.col("slope") * F.date_diff("predict_dt", "first_day") + F.col("bend") * after
    return days.select(*keys, "predict_dt", at_least(pred).alias("pred"))


# Smoothing weights tried per series.  The smallest weight of each row stands for
# "let the optimiser choose", which has no counterpart here.
ALPHAS = (0.1, 0.3, 0.5, 0.7)
BETAS = (0.05, 0.3, 0.5, 0.7)
GAMMAS = (0.05, 0.1, 0.3)


def season_length(history: Column, window: int) -> Column:
    """Thirty days where the history covers the window twice, else two."""
    return F.when(F.size(history) >= 2 * window, F.lit(30)).otherwise(F.lit(2))


def _smooth(history: Column, period: Column, alpha: Column, beta: Column, gamma: Column, keep_fit: bool) -> Column:
    """Additive Holt-Winters as a fold: level, trend, the seasonal queue and the fit so far.

    The state starts from the first two seasons; ``miss`` sums the relative errors of the rounded fit.
    """
    first = F.slice(history, F.lit(1), period)
    second = F.slice(history, period + 1, period)
    level0 = array_mean(first)
    start = F.struct(
        level0.alias("level"),
        ((array_mean(second) - level0) / period).alias("trend"),
        F.transform(first, lambda v: v - level0).alias("season"),
        F.lit(0.0).alias("miss"),
        F.array().cast("array<double>").alias("fit"),
    )

    def step(s: Column, y: Column) -> Column:
        ahead = s["level"] + s["trend"]
        head = F.get(s["season"], F.lit(0))
        fitted = half_even(ahead + head, 1)
        level = alpha * (y - head) + (1 - alpha) * ahead
        return F.struct(
            level.alias("level"),
            (beta * (level - s["level"]) + (1 - beta) * s["trend"]).alias("trend"),
            F.concat(
                F.slice(s["season"], F.lit(2), period - 1), F.array(gamma * (y - ahead) + (1 - gamma) * head)
            ).alias("season"),
            (s["miss"] + F.abs(fitted - y) / F.greatest(F.abs(y), F.lit(RELATIVE_FLOOR))).alias("miss"),
            (F.concat(s["fit"], F.array(fitted)) if keep_fit else s["fit"]).alias("fit"),
        )

    return F.aggregate(history, start, step)


def holt_winters(
    df: DataFrame, keys: Sequence[str], time: str, value: str, alpha: float, beta: float, gamma: float, window: int
) -> DataFrame:
    """Forecast of ``window`` days per key with given weights, rounded to one digit and floored at zero.

    Series of two values or fewer give nothing.
    """
    series = history_arrays(df, keys, time, value).where(F.size("history") > 2)
    series = series.withColumn("period", season_length(F.col("history"), window))
    state = _smooth(F.col("history"), F.col("period"), F.lit(alpha), F.lit(beta), F.lit(gamma), False)
    ready = series.withColumn("_state", state)
    s = F.col("_state")
    steps = F.transform(
        F.sequence(F.lit(1), F.lit(window)),
        lambda h: at_least(
            half_even(s["level"] + h * s["trend"] + F.get(s["season"], F.pmod(h - 1, F.col("period"))), 1)
        ),
    )
    return explode_steps(ready.withColumn("_steps", steps), keys, "_steps", "pred")


def holt_winters_fit(
    df: DataFrame, keys: Sequence[str], time: str, value: str, alpha: float, beta: float, gamma: float, window: int
) -> DataFrame:
    """One-step-ahead fit of every day of the history."""
    days = history_arrays(df.withColumn("_day", F.unix_date(time).cast("double")), keys, time, "_day")
    series = history_arrays(df, keys, time, value).where(F.size("history") > 2)
    series = series.withColumn("period", season_length(F.col("history"), window))
    state = _smooth(F.col("history"), F.col("period"), F.lit(alpha), F.lit(beta), F.lit(gamma), True)
    fitted = series.withColumn("_fit", state["fit"]).join(days.select(*keys, F.col("history").alias("_days")), list(keys))
    rows = fitted.select(*keys, F.inline(F.arrays_zip("_days", "_fit")))
    return rows.select(*keys, F.date_from_unix_date(F.col("_days").cast("int")).alias(time), F.col("_fit").alias("pred"))


def holt_winters_search(df: DataFrame, keys: Sequence[str], time: str, value: str, window: int) -> DataFrame:
    """Weights with the best training accuracy per key.

    All weights are tried inside the row of a key, so the search adds no shuffle.
    """
    grid = F.array(
        *(
            F.struct(F.lit(a).alias("alpha"), F.lit(b).alias("beta"), F.lit(g).alias("gamma"))
            for a, b, g in product(ALPHAS, BETAS, GAMMAS)
        )
    )
    series = history_arrays(df, keys, time, value).where(F.size("history") > 2)
    series = series.withColumn("periods", season_length(F.col("history"), window))
    length = F.size("history")

    def scored(p: Column) -> Column:
        state = _smooth(F.col("history"), F.col("periods"), p["alpha"], p["beta"], p["gamma"], False)
        return F.struct(
            half_even(1 - half_even(state["miss"] / length, 4), 4).alias("ACC"),
            (-p["alpha"]).alias("a"),
            (-p["beta"]).alias("b"),
            (-p["gamma"]).alias("g"),
        )

    # Among equal scores the smallest weights win, hence the negated weights in the struct.
    best = series.withColumn("_best", F.array_max(F.transform(grid, scored)))
    return best.select(
        *keys,
        (-F.col("_best.a")).alias("alpha"),
        (-F.col("_best.b")).alias("beta"),
        (-F.col("_best.g")).alias("gamma"),
        F.col("periods").cast("long").alias("periods"),
        length.cast("long").alias("length"),
        F.col("_best.ACC").alias("ACC"),
    )


def holt_winters_tuned(df: DataFrame, keys: Sequence[str], time: str, value: str, window: int, rounds: int = 5) -> DataFrame:
    """Weights refined from the best of the grid: ``keys, alpha, beta, gamma, periods, length, ACC``.

    Each round tries every weight a step up and down, within (0, 1), keeps what raises the training accuracy, and halves the step; so the
    accuracy is never below the grid's best.  All of it is one fold inside the row of a key.
    """
    found = holt_winters_search(df, keys, time, value, window).drop("periods", "length")
    series = history_arrays(df, keys, time, value).withColumn("periods", season_length(F.col("history"), window)).join(found, list(keys))
    length = F.size("history")

    def accuracy(p: dict[str, Column]) -> Column:
        state = _smooth(F.col("history"), F.col("periods"), p["alpha"], p["beta"], p["gamma"], False)
        return half_even(1 - half_even(state["miss"] / length, 4), 4)

    def point(p: dict[str, Column], score: Column) -> Column:
        return F.struct(score.alias("ACC"), *(p[c].alias(c) for c in ("alpha", "beta", "gamma")))

    def nudged(s: Column, turn: Column) -> Column:
        # Six tries a round: turn % 6 names the weight and the direction.
        step = F.pow(F.lit(0.5), F.floor(turn / 6) + 3)
        way = F.when(turn % 2 == 0, step).otherwise(-step)
        weights = {}
        for k, c in enumerate(("alpha", "beta", "gamma")):
            moved = F.least(F.greatest(s[c] + way, F.lit(0.01)), F.lit(0.99))
            weights[c] = F.when(F.floor(turn / 2) % 3 == k, moved).otherwise(s[c])
        tried = F.get(F.transform(F.array(F.struct(*(v.alias(c) for c, v in weights.items()))), lambda w: point({c: w[c] for c in weights}, accuracy({c: w[c] for c in weights}))), F.lit(0))
        return F.get(F.transform(F.array(tried), lambda t: F.when(t["ACC"] > s["ACC"], t).otherwise(s)), F.lit(0))

    start = point({c: F.col(c) for c in ("alpha", "beta", "gamma")}, F.col("ACC"))
    best = series.withColumn("_best", F.aggregate(F.sequence(F.lit(0), F.lit(6 * rounds - 1)), start, nudged))
    return best.select(
        *keys, "_best.alpha", "_best.beta", "_best.gamma", F.col("periods").cast("long").alias("periods"), length.cast("long").alias("length"), "_best.ACC"
    )
