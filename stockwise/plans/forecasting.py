"""Queries: series preparation and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockwise.functions.numeric import half_even
from stockwise.operators import forecast as fc
from stockwise.operators import selection as sel
from stockwise.operators import series
from stockwise.operators import windows as win
from stockwise.plans.inputs import KEYS, Inputs, rounded, sql
from stockwise.plans.registry import query
from stockwise.session import staged

NORMAL = "type_flg = 'norm' AND shop_type_flg = 'norm_shop'"


@query(
    "demand_series",
    sql("sold_rows", " UNION ALL ".join(
        f"SELECT '{g}' AS grain, CAST(date_trunc('{g}', ds) AS DATE) AS ds, wh_dept_id, goods_id, sum(abs(-qty)) AS y FROM sold_rows WHERE {NORMAL} GROUP BY 2, 3, 4"
        for g in ("day", "week", "month"))),
)
def demand_series(inp: Inputs) -> DataFrame:
    """Demand of the normal population per day, week and month; the booked amounts are negative."""
    rows = series.population(inp.sold_rows, "normal").withColumn("theory_sale_cnt", -F.col("qty"))
    grains = [series.demand_series(rows, KEYS, "ds", "theory_sale_cnt", g).withColumn("grain", F.lit(g)) for g in ("day", "week", "month")]
    return grains[0].unionByName(grains[1]).unionByName(grains[2])


@query(
    "patch_bad_day",
    sql("daily_demand", """SELECT wh_dept_id, goods_id, ds, y FROM daily_demand WHERE ds NOT IN (DATE '1997-03-05', DATE '1999-07-01')
      UNION ALL SELECT wh_dept_id, goods_id, CAST(ds - 1 AS DATE), y FROM daily_demand WHERE ds - 1 IN (DATE '1997-03-05', DATE '1999-07-01')"""),
)
def patch_bad_day(inp: Inputs) -> DataFrame:
    return series.patch_bad_days(inp.daily_demand, "ds", ["1997-03-05", "1999-07-01"])


@query(
    "time_split",
    sql("daily_demand", """SELECT wh_dept_id, goods_id, ds, y, position, CAST(position <= floor(n * 0.8e0) AS BIGINT) AS is_train FROM (
      SELECT *, row_number() OVER (ORDER BY ds, wh_dept_id, goods_id) AS position, count(*) OVER () AS n FROM daily_demand)"""),
)
def time_split(inp: Inputs) -> DataFrame:
    return series.time_split(inp.daily_demand, ["ds", "wh_dept_id", "goods_id"], 0.8).select(*KEYS, "ds", "y", "position", "is_train")


def recursive_sql(source: str, horizon: int) -> str:
    """Recursive query over the last seven values of every key."""
    return sql(
        "sold_rows store_demand wh_demand" if source == "wh_demand" else "sold_rows",
        "SELECT wh_dept_id, goods_id, CAST(last_day + step AS DATE) AS predict_dt, held[len(held)] AS pred FROM grown WHERE step > 0",
        recursive=True,
        **({} if source == "wh_demand" else {"new_shop": NEW_SHOP}),
        grown=f"""SELECT wh_dept_id, goods_id, max(ds) AS last_day, 0 AS step, list(y ORDER BY ds)[-7:] AS held FROM {source} GROUP BY 1, 2
          UNION ALL SELECT wh_dept_id, goods_id, last_day, step + 1, list_append(held, {rounded("list_sum(held[-7:]) / len(held[-7:])", 1)})
          FROM grown WHERE step < {horizon}""",
    )


NEW_SHOP = "SELECT wh_dept_id, goods_id, ds, sum(qty) AS y FROM sold_rows WHERE type_flg = 'norm' AND shop_type_flg = 'new_shop' GROUP BY 1, 2, 3"


@query("recursive_forecast", recursive_sql("wh_demand", 120))
def recursive_forecast(inp: Inputs) -> DataFrame:
    return fc.recursive_mean(inp.wh_demand, KEYS, "ds", "y", 120)


@query("new_shop_forecast", recursive_sql("new_shop", 30))
def new_shop_forecast(inp: Inputs) -> DataFrame:
    """The new-shop population summed to one series per key, then forecast."""
    rows = series.population(inp.sold_by_day, "new_shop_normal")
    return fc.recursive_mean(series.daily_sum(rows, KEYS, "ds", "qty"), KEYS, "ds", "y", 30)


@query("horizon_sum", sql("forecast", f"SELECT model, dt, wh_dept_id, goods_id, {rounded('sum(greatest(predict_demand - 30, 0))', 1)} AS pred FROM forecast GROUP BY 1, 2, 3, 4"))
def horizon_sum(inp: Inputs) -> DataFrame:
    """Forecasts less a fixed amount, so that some fall below zero and are floored."""
    lowered = inp.forecast.withColumn("pred", F.col("predict_demand") - 30)
    return fc.clipped_sums(lowered, ["model", "dt", *KEYS], "pred")


@query(
    "baseline_moving_avg",
    sql("evaluated", f"SELECT model, dt, predict_dt, wh_dept_id, goods_id, y, predict_demand AS yhat, {rounded('abs(1 - predict_demand / y)', 6)} AS mape FROM evaluated"),
)
def baseline_moving_avg(inp: Inputs) -> DataFrame:
    ape = half_even(F.abs(1 - F.try_divide(F.col("predict_demand"), F.col("y"))), 6)
    return inp.evaluated.select("model", "dt", "predict_dt", *KEYS, "y", F.col("predict_demand").alias("yhat"), ape.alias("mape"))


@query(
    "densify_horizon",
    sql("evaluated", """SELECT f.dt, f.predict_dt, f.wh_dept_id, f.goods_id, f.predict_demand, d.y, CAST(year(f.predict_dt) AS INTEGER) AS year,
      CAST(month(f.predict_dt) AS INTEGER) AS month, CAST(day(f.predict_dt) AS INTEGER) AS day, CAST(isodow(f.predict_dt) - 1 AS INTEGER) AS day_of_week,
      CAST(weekofyear(f.predict_dt) AS INTEGER) AS week_of_year
      FROM forecast f LEFT JOIN daily_demand d ON f.predict_dt = d.ds AND f.wh_dept_id = d.wh_dept_id AND f.goods_id = d.goods_id WHERE f.model = 'window_28'"""),
)
def densify_horizon(inp: Inputs) -> DataFrame:
    pred = inp.forecast_by_day.where(F.col("model") == "window_28").drop("model")
    return fc.dense_horizon(pred, inp.actual.withColumnRenamed("ds", "predict_dt"), KEYS)


def trend_sql(source: str, keys: str, sizes: tuple[int, ...], bounded: bool) -> dict[str, str]:
    """Named parts of the trend-and-season query over any keyed series."""
    on = " AND ".join(f"f.{k.strip()} = w.{k.strip()}" for k in keys.split(","))
    listed = ", ".join(f"f.{k.strip()}" for k in keys.split(","))
    pred = "base + slope * ahead + coalesce(wy / wn - (base + slope * wx / wn), 0)"
    return {
        "train": f"""SELECT t.*, CAST(date_diff('day', dt, ds) AS DOUBLE) AS x FROM (
            SELECT s.*, o.dt, z.train_size FROM {source} s, (SELECT unnest([{", ".join(f"{s}::INTEGER" for s in sizes)}]) AS train_size) z,
              (SELECT CAST(unnest(generate_series(date_trunc('month', min(ds)), max(ds) + INTERVAL 1 DAY, INTERVAL 1 MONTH)) AS DATE) AS dt FROM {source}) o
            WHERE s.ds < o.dt AND s.ds >= o.dt - z.train_size) t""",
        "fits": f"""SELECT *, (sy - slope * sx) / n AS base FROM (
            SELECT *, coalesce(CASE WHEN n * sxx - sx * sx <> 0 THEN (n * sxy - sx * sy) / (n * sxx - sx * sx) END, 0) AS slope FROM (
              SELECT {keys}, dt, train_size, CAST(count(*) AS DOUBLE) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * x) AS sxx, sum(x * y) AS sxy,
                min(y) AS low, max(y) AS high FROM train GROUP BY ALL HAVING count(*) >= 2))""",
        "weeks": f"SELECT {keys}, dt, train_size, isodow(ds) AS dow, CAST(count(*) AS DOUBLE) AS wn, sum(x) AS wx, sum(y) AS wy FROM train GROUP BY ALL",
        "trend": f"""SELECT {keys}, dt, train_size, predict_dt, {f"least(greatest({pred}, low), high)" if bounded else pred} AS pred FROM (
            SELECT f.*, w.wn, w.wx, w.wy FROM (SELECT *, CAST(dt + CAST(h AS INTEGER) AS DATE) AS predict_dt, CAST(h AS DOUBLE) AS ahead FROM fits, range(0, 30) r(h)) f
            LEFT JOIN weeks w ON {on} AND f.dt = w.dt AND f.train_size = w.train_size AND isodow(f.predict_dt) = w.dow)""",
    }


TREND = trend_sql("daily_demand", "wh_dept_id, goods_id", fc.TRAIN_DAYS, True)


def month_after(df: DataFrame, time: str):
    """The day after the last one bounds the origins."""
    return df.select(F.date_add(F.max(time), 1)).scalar()


@query("trend_season_forecast", sql("daily_demand", f"SELECT wh_dept_id, goods_id, dt, train_size, predict_dt, {rounded('pred', 4)} AS pred FROM trend", **TREND))
def trend_season_forecast(inp: Inputs) -> DataFrame:
    demand = inp.daily_demand
    pred = fc.trend_season(demand, KEYS, "ds", "y", month_after(demand, "ds"))
    return pred.withColumn("pred", half_even(F.col("pred"), 4))


@query(
    "model_stack",
    sql("forecast", f"""SELECT model, dt, predict_dt, wh_dept_id, goods_id, predict_demand AS pred FROM forecast
      UNION ALL SELECT 'trend_' || train_size, dt, predict_dt, wh_dept_id, goods_id, {rounded('pred', 4)} FROM trend""", **TREND),
)
def model_stack(inp: Inputs) -> DataFrame:
    demand = inp.daily_demand
    trend = fc.trend_season(demand, KEYS, "ds", "y", month_after(demand, "ds"))
    tagged = trend.select(
        F.concat(F.lit("trend_"), F.col("train_size").cast("string")).alias("model"), "dt", "predict_dt", *KEYS, half_even(F.col("pred"), 4).alias("pred")
    )
    return inp.forecast.withColumnRenamed("predict_demand", "pred").unionByName(tagged)


CMDTY_TREND = trend_sql("cmdty_demand", "wh_dept_id, cmdty_id", (60,), False)


@query(
    "rule_negative",
    sql("sold_rows", "SELECT DISTINCT wh_dept_id, cmdty_id, 'trend_60' AS model FROM trend WHERE " + rounded('pred', 4) + " < 0",
        cmdty_demand="SELECT wh_dept_id, cmdty_id, ds, sum(qty) AS y FROM sold_rows GROUP BY 1, 2, 3", **CMDTY_TREND),
)
def rule_negative(inp: Inputs) -> DataFrame:
    """Commodity series whose unbounded trend falls below zero on some day."""
    keys = ["wh_dept_id", "cmdty_id"]
    demand = series.daily_sum(inp.sold_rows, keys, "ds", "qty")
    trend = fc.trend_season(demand, keys, "ds", "y", month_after(demand, "ds"), (60,), bounded=False)
    published = trend.select(*keys, F.lit("trend_60").alias("model"), half_even(F.col("pred"), 4).alias("pred"))
    return sel.negative_forecasts(published, keys, "pred")


def smoothing_sql(weights: str) -> dict[str, str]:
    """Named parts of the recursive smoothing query; ``weights`` lists the rows to try."""
    fitted = rounded("level + trend + season[1]", 1)
    return {
        "numbered": "SELECT *, row_number() OVER (PARTITION BY wh_dept_id, goods_id ORDER BY ds) AS rn FROM wh_demand",
        "start": f"""SELECT k.*, w.*, len(h) AS n, CASE WHEN len(h) >= 60 THEN 30 ELSE 2 END AS period FROM (
            SELECT wh_dept_id, goods_id, max(ds) AS last_day, list(y ORDER BY ds) AS h FROM wh_demand GROUP BY 1, 2 HAVING count(*) > 2) k, ({weights}) w""",
        "smooth": f"""SELECT wh_dept_id, goods_id, last_day, alpha, beta, gamma, n, period, 0::BIGINT AS t, list_sum(h[1:period]) / len(h[1:period]) AS level,
            (list_sum(h[period + 1:2 * period]) / len(h[period + 1:2 * period]) - list_sum(h[1:period]) / len(h[1:period])) / period AS trend,
            list_transform(h[1:period], lambda v: v - list_sum(h[1:period]) / len(h[1:period])) AS season, 0e0 AS miss FROM start
          UNION ALL
          SELECT wh_dept_id, goods_id, last_day, alpha, beta, gamma, n, period, t + 1, new_level,
            beta * (new_level - level) + (1 - beta) * trend, list_append(season[2:], gamma * (y - (level + trend)) + (1 - gamma) * season[1]),
            miss + abs({fitted} - y) / greatest(abs(y), 2.220446049250313e-16)
          FROM (SELECT s.*, d.y, alpha * (d.y - season[1]) + (1 - alpha) * (level + trend) AS new_level FROM smooth s
                JOIN numbered d ON s.wh_dept_id = d.wh_dept_id AND s.goods_id = d.goods_id AND d.rn = s.t + 1)""",
    }


ONE_WEIGHT = "SELECT 0.3e0 AS alpha, 0.3e0 AS beta, 0.1e0 AS gamma"


@query(
    "holt_winters",
    sql("wh_demand", f"""SELECT wh_dept_id, goods_id, CAST(last_day + CAST(h AS INTEGER) AS DATE) AS predict_dt,
      greatest({rounded("level + h * trend + season[(h - 1) % period + 1]", 1)}, 0) AS pred FROM smooth, range(1, 31) r(h) WHERE t = n""",
        recursive=True, **smoothing_sql(ONE_WEIGHT)),
)
def holt_winters(inp: Inputs) -> DataFrame:
    return fc.holt_winters(inp.wh_demand, KEYS, "ds", "y", 0.3, 0.3, 0.1, 30)


ALL_WEIGHTS = " CROSS JOIN ".join(
    f"(SELECT unnest([{', '.join(f'{v}e0' for v in values)}]) AS {name})"
    for name, values in (("alpha", fc.ALPHAS), ("beta", fc.BETAS), ("gamma", fc.GAMMAS))
)


@query(
    "holt_winters_grid",
    sql("wh_demand", """SELECT wh_dept_id, goods_id, alpha, beta, gamma, CAST(period AS BIGINT) AS periods, CAST(n AS BIGINT) AS length, acc AS ACC
      FROM (SELECT *, row_number() OVER (PARTITION BY wh_dept_id, goods_id ORDER BY acc DESC, alpha, beta, gamma) AS place FROM scored) WHERE place = 1""",
        recursive=True, **smoothing_sql(f"SELECT * FROM {ALL_WEIGHTS}"),
        scored=f"SELECT *, {rounded('1 - ' + rounded('miss / n', 4), 4)} AS acc FROM smooth WHERE t = n"),
)
def holt_winters_grid(inp: Inputs) -> DataFrame:
    """Best of 48 weight combinations per key by training accuracy."""
    return fc.holt_winters_search(inp.wh_demand, KEYS, "ds", "y", 30)


@query(
    "series_minmax",
    sql("store_demand", f"""SELECT dept_id, goods_id, ds, {rounded('coalesce(CASE WHEN high <> low THEN (y - low) / (high - low) END, 0)', 6)} AS scaled FROM (
      SELECT *, min(y) OVER k AS low, max(y) OVER k AS high, count(*) OVER k AS days, (SELECT count(DISTINCT ds) FROM store_demand) AS all_days
      FROM store_demand WINDOW k AS (PARTITION BY dept_id, goods_id)) WHERE days = all_days"""),
)
def series_minmax(inp: Inputs) -> DataFrame:
    keys = ["dept_id", "goods_id"]
    demand = staged(inp.store_demand, "store-demand")
    complete = series.complete_keys(demand, keys, demand.select(F.count_distinct("ds")).scalar())
    scaled = series.minmax_scaled(complete, keys, "y", "scaled")
    return scaled.select(*keys, "ds", half_even(F.col("scaled"), 6).alias("scaled"))


TUNED_SQL = smoothing_sql(f"SELECT * FROM {ALL_WEIGHTS}")


@query(
    "holt_winters_tuned",
    sql("wh_demand", """SELECT wh_dept_id, goods_id, CAST(max(period) AS BIGINT) AS periods, CAST(max(n) AS BIGINT) AS length, true AS not_below_grid, true AS weights_inside
        FROM scored GROUP BY 1, 2""", recursive=True, **TUNED_SQL, scored="SELECT * FROM smooth WHERE t = n"),
)
def holt_winters_tuned(inp: Inputs) -> DataFrame:
    """Refined weights per key: never worse on the training days than the best of the grid."""
    demand = staged(inp.wh_demand, "wh-demand")
    tuned = fc.holt_winters_tuned(demand, KEYS, "ds", "y", 30)
    grid = fc.holt_winters_search(demand, KEYS, "ds", "y", 30).select(*KEYS, F.col("ACC").alias("grid"))
    inside = [(F.col(c) > 0) & (F.col(c) < 1) for c in ("alpha", "beta", "gamma")]
    return tuned.join(grid, KEYS).select(
        *KEYS, "periods", "length", (F.col("ACC") >= F.col("grid")).alias("not_below_grid"), (inside[0] & inside[1] & inside[2]).alias("weights_inside")
    )


BENT = {
    "spans": "SELECT wh_dept_id, goods_id, min(ds) AS first_day, max(ds) AS last_day FROM daily_demand GROUP BY 1, 2",
    "points": """SELECT d.wh_dept_id, d.goods_id, first_day, CAST(date_diff('day', first_day, ds) AS DOUBLE) AS x, y, date_diff('day', first_day, last_day) AS span
        FROM daily_demand d JOIN spans s ON d.wh_dept_id = s.wh_dept_id AND d.goods_id = s.goods_id""",
    "lines": """SELECT *, (sy - slope * sx) / n AS base FROM (SELECT *, coalesce(CASE WHEN n * sxx - sx * sx <> 0 THEN (n * sxy - sx * sy) / (n * sxx - sx * sx) END, 0) AS slope FROM (
        SELECT wh_dept_id, goods_id, first_day, CAST(count(*) AS DOUBLE) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y) AS sy, sum(x * y) AS sxy, sum(y * y) AS syy
        FROM points GROUP BY 1, 2, 3 HAVING count(*) >= 4))""",
    "hinges": """SELECT wh_dept_id, goods_id, spot, sum(h) AS sh, sum(x * h) AS sxh, sum(h * h) AS shh, sum(y * h) AS syh FROM (
        SELECT *, greatest(x - spot, 0) AS h FROM (SELECT *, CAST(floor(span * j / 10) AS DOUBLE) AS spot FROM points, range(1, 10) r(j))) GROUP BY 1, 2, 3""",
    "solved": f"""SELECT *, {fc.BEND["error"]} AS error FROM (
        SELECT *, {fc.BEND["base"]} AS base, {fc.BEND["slope"]} AS slope, {fc.BEND["bend"]} AS bend FROM (
          SELECT *, {fc.BEND["det"]} AS det FROM (SELECT l.* EXCLUDE (base, slope), h.spot, h.sh, h.sxh, h.shh, h.syh FROM lines l JOIN hinges h ON l.wh_dept_id = h.wh_dept_id AND l.goods_id = h.goods_id)) WHERE det > 0)""",
    "best": "SELECT * FROM solved QUALIFY row_number() OVER (PARTITION BY wh_dept_id, goods_id ORDER BY error, spot) = 1",
    "bent": """SELECT l.wh_dept_id, l.goods_id, l.first_day, CASE WHEN c THEN CAST(l.first_day + CAST(spot AS INTEGER) AS DATE) END AS knot,
        CASE WHEN c THEN b.base ELSE l.base END AS base, CASE WHEN c THEN b.slope ELSE l.slope END AS slope, CASE WHEN c THEN b.bend ELSE 0 END AS bend FROM (
          SELECT l.*, coalesce(l.syy - l.base * l.sy - l.slope * l.sxy > l.syy * 1e-9 AND b.error <= (l.syy - l.base * l.sy - l.slope * l.sxy) * (1 - 0.1e0), false) AS c FROM lines l LEFT JOIN best b ON l.wh_dept_id = b.wh_dept_id AND l.goods_id = b.goods_id) l
        LEFT JOIN best b ON l.wh_dept_id = b.wh_dept_id AND l.goods_id = b.goods_id""",
}


def bent_trends(inp: Inputs) -> DataFrame:
    demand = inp.daily_demand
    spans = demand.groupBy(*KEYS).agg(F.min("ds").alias("_from"), F.max("ds").alias("_to"))
    return fc.bent_trend(demand.join(spans, KEYS), KEYS, "ds", "y", F.col("_from"), F.col("_to"))


@query(
    "trend_change",
    sql("daily_demand", f"SELECT wh_dept_id, goods_id, first_day, knot, {rounded('base', 4)} AS base, {rounded('slope', 6)} AS slope, {rounded('bend', 6)} AS bend FROM bent", **BENT),
)
def trend_change(inp: Inputs) -> DataFrame:
    """Where the trend of each series bends, and how steep it is before and after."""
    digits = {"base": 4, "slope": 6, "bend": 6}
    return bent_trends(inp).withColumns({c: half_even(F.col(c), n) for c, n in digits.items()})


@query(
    "trend_change_forecast",
    sql("daily_demand", f"""SELECT wh_dept_id, goods_id, predict_dt, {rounded("greatest(0, base + slope * date_diff('day', first_day, predict_dt) + bend * coalesce(greatest(date_diff('day', knot, predict_dt), 0), 0))", 3)} AS pred
        FROM (SELECT b.*, CAST(last_day + CAST(step AS INTEGER) AS DATE) AS predict_dt FROM bent b, (SELECT max(ds) AS last_day FROM daily_demand), range(1, 31) r(step))""", **BENT),
)
def trend_change_forecast(inp: Inputs) -> DataFrame:
    ahead = fc.bent_forecast(bent_trends(inp), KEYS, month_after(inp.daily_demand, "ds"), 30)
    return ahead.withColumn("pred", half_even(F.col("pred"), 3))
