"""Queries: data-quality checks and forecast monitors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockwise.functions.dates import first_of
from stockwise.functions.numeric import BAND_LABELS, half_even
from stockwise.operators import aggregate as agg
from stockwise.operators import forecast as fc
from stockwise.operators import quality, series
from stockwise.operators import selection as sel
from stockwise.operators import windows as win
from stockwise.plans.accuracy_marts import MONTHLY, NEWEST, VIEWS, recent, recent_sql
from stockwise.plans.aggregating import BAND_COUNTS, BAND_RATIOS
from stockwise.plans.columns import BAND_CASE
from stockwise.plans.forecasting import recursive_sql
from stockwise.plans.inputs import KEYS, Inputs, rounded, sql
from stockwise.plans.registry import query
from stockwise.session import staged


@query(
    "dq_invalid_count",
    """SELECT total, rule, bad, total > 0 AND bad = 0 AS passed FROM (
         SELECT count(*) AS total, unnest(['discount_in_list', 'positive_quantity', 'shipped_after_1996']) AS rule,
           unnest([count(*) FILTER (WHERE l_discount NOT IN (0.0, 0.02, 0.04, 0.06, 0.08)), count(*) FILTER (WHERE l_quantity <= 0),
                   count(*) FILTER (WHERE l_shipdate < TIMESTAMP '1996-01-01')]) AS bad FROM lineitem)""",
)
def dq_invalid_count(inp: Inputs) -> DataFrame:
    rules = {
        "discount_in_list": ~F.col("l_discount").isin(0.0, 0.02, 0.04, 0.06, 0.08),
        "positive_quantity": F.col("l_quantity") <= 0,
        "shipped_after_1996": F.col("l_shipdate") < F.lit("1996-01-01").cast("timestamp"),
    }
    return quality.invalid_counts(inp.table("lineitem"), rules)


@query(
    "forecast_compare",
    sql("forecast", f"""SELECT goods_id, dmd_new, dmd_online, lag_1 * 30 AS lag_1_sum, lag_n, {rounded('dmd_new / nullif(dmd_online, 0)', 1)} AS ratio,
        {rounded('dmd_new / nullif(lag_1 * 30, 0)', 1)} AS ratio_1, {rounded('dmd_new / nullif(lag_n, 0)', 1)} AS ratio_n FROM (
      SELECT goods_id, {rounded("sum(predict_demand) FILTER (WHERE model = 'window_7')", 1)} AS dmd_new, {rounded("sum(predict_demand) FILTER (WHERE model = 'window_28')", 1)} AS dmd_online
      FROM (SELECT *, row_number() OVER (PARTITION BY model, wh_dept_id, goods_id ORDER BY predict_dt) AS rn FROM forecast WHERE dt = (SELECT max(dt) FROM forecast)) WHERE rn <= 30 GROUP BY 1) a
      JOIN (SELECT goods_id, sum(y) FILTER (WHERE ds = last) AS lag_1, sum(y) AS lag_n FROM (SELECT *, (SELECT max(ds) FROM daily_demand) AS last FROM daily_demand) WHERE ds > last - 30 GROUP BY 1) b
      USING (goods_id)"""),
)
def forecast_compare(inp: Inputs) -> DataFrame:
    newest = win.newest_slice(inp.forecast, "dt")
    new, online = (newest.where(F.col("model") == m) for m in ("window_7", "window_28"))
    return quality.forecast_comparison(new, online, inp.daily_demand)


@query(
    "spike_alert",
    sql("store_demand", f"""SELECT dept_id, goods_id, ds, y, ratio_1, ratio_7 FROM (
      SELECT *, {rounded('y / nullif(m1, 0)', 1)} AS ratio_1, {rounded('y / nullif(m7, 0)', 1)} AS ratio_7 FROM (
        SELECT *, lag(y) OVER (PARTITION BY dept_id, goods_id ORDER BY ds) AS m1,
          avg(y) OVER (PARTITION BY dept_id, goods_id ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS m7 FROM store_demand)) WHERE ratio_1 >= 2 OR ratio_7 >= 2"""),
)
def spike_alert(inp: Inputs) -> DataFrame:
    keys = ["dept_id", "goods_id"]
    feats = win.trailing_means(inp.store_demand, keys, "ds", "y", (1, 7))
    return quality.spikes(feats).select(*keys, "ds", "y", "ratio_1", "ratio_7")


@query(
    "model_usage",
    sql(VIEWS, f"""SELECT * EXCLUDE ({', '.join(BAND_LABELS)}), {BAND_RATIOS} FROM (
      SELECT model, count(*) AS total, {rounded('avg(round_even(last_1_acc * 1e4, 0)) / 1e4', 3)} AS mean_acc, {rounded('min(last_1_acc)', 3)} AS min_acc, {BAND_COUNTS} FROM (
        SELECT *, {BAND_CASE} AS band FROM (SELECT *, 1 - last_1_acc AS err, row_number() OVER (PARTITION BY wh_dept_id, goods_id ORDER BY last_1_acc DESC, model) AS place
          FROM recent WHERE newest = 1) WHERE place = 1) GROUP BY 1)""", **MONTHLY, recent=NEWEST.format(recent_sql((1,)))),
)
def model_usage(inp: Inputs) -> DataFrame:
    """How often each model is the chosen one, how well it does, and its error bands."""
    best = sel.latest_best_model(recent(inp, 1), KEYS, "dt", "last_1_acc")
    usage = best.groupBy("model").agg(
        half_even(F.avg(F.rint(F.col("last_1_acc") * 1e4)) / 1e4, 3).alias("mean_acc"), half_even(F.min("last_1_acc"), 3).alias("min_acc")
    )
    bands = agg.band_ratios(best, ["model"], {"model": []}, 1 - F.col("last_1_acc"))
    return usage.join(bands.select("model", "total", *(f"{b}_ratio" for b in BAND_LABELS)), "model")


@query(
    "missing_exclusions",
    sql("", """SELECT DISTINCT goods_id FROM launches JOIN formula USING (cmdty_id)
      WHERE goods_id NOT IN (SELECT p_size % 8 FROM rows WHERE p_size % 3 = 1 AND ds = (SELECT max(ds) FROM rows))""",
        rows="SELECT p_size, CAST(l_shipdate AS DATE) AS ds FROM lineitem JOIN part ON l_partkey = p_partkey",
        plan="SELECT p_size AS cmdty_id, CAST(date_trunc('week', ds) AS DATE) AS launch FROM rows",
        formula="SELECT DISTINCT p_size AS cmdty_id, CAST(p_size % 8 AS BIGINT) AS goods_id FROM part",
        launches="""SELECT cmdty_id FROM (
            SELECT cmdty_id, launch, count(*) AS shop_nums, row_number() OVER (PARTITION BY cmdty_id ORDER BY launch DESC) AS rn
            FROM plan, (SELECT max(ds) + 1 AS run_day FROM rows) WHERE launch > run_day - 21 AND launch < run_day GROUP BY 1, 2)
          WHERE rn = 1 AND shop_nums >= 2"""),
)
def missing_exclusions(inp: Inputs) -> DataFrame:
    """Goods of commodities launched widely in the last three weeks that the newest day does not mark as recent.

    A commodity is a size, sold rows of a week stand for the shops that launched it; two shops are wide enough here.
    """
    part = inp.table("part").select("p_partkey", F.col("p_size").alias("cmdty_id"))
    line = inp.table("lineitem").select("l_partkey", F.to_date("l_shipdate").alias("ds"))
    sizes = series.spread_for(part, "p_partkey", line.count())
    rows = line.join(sizes, line.l_partkey == sizes.p_partkey).select("cmdty_id", "ds")
    goods = (F.col("cmdty_id") % 8).cast("long").alias("goods_id")
    plan = rows.select("cmdty_id", first_of("week", F.col("ds")).alias("launch"))
    run_day = F.date_add(rows.select(F.max("ds")).scalar(), 1)
    launches = quality.recent_launches(plan, "cmdty_id", "launch", run_day, least_shops=2)
    expected = part.select("cmdty_id", goods).distinct().join(launches, "cmdty_id", "left_semi")
    marked = win.newest_slice(rows, "ds").where(F.col("cmdty_id") % 3 == 1).select(goods)
    return quality.missing_members(expected, marked, ["goods_id"])


@query(
    "history_forecast_trend",
    recursive_sql("wh_demand", 120).replace(
        "SELECT wh_dept_id, goods_id, CAST(last_day + step AS DATE) AS predict_dt, held[len(held)] AS pred FROM grown WHERE step > 0",
        f"""SELECT goods_id, ds AS dt, sum(y) AS amount, 'actual' AS kind FROM wh_demand WHERE ds > (SELECT max(ds) FROM wh_demand) - 120 GROUP BY 1, 2
      UNION ALL SELECT goods_id, CAST(last_day + step AS DATE), {rounded('sum(held[len(held)])', 1)}, 'pred' FROM grown WHERE step > 0 GROUP BY 1, 2"""),
)
def history_forecast_trend(inp: Inputs) -> DataFrame:
    demand = staged(inp.wh_demand, "wh-demand")
    return quality.history_and_forecast(demand, fc.recursive_mean(demand, KEYS, "ds", "y", 120), 120)


@query(
    "row_count_ratio",
    f"""SELECT ds, rows, rows_before, {rounded('rows / rows_before', 4)} AS ratio, CASE WHEN rows / rows_before < 0.8 THEN 'low' WHEN rows / rows_before > 1.5 THEN 'high' ELSE 'ok' END AS state
        FROM (SELECT *, lag(rows) OVER (ORDER BY ds) AS rows_before FROM (SELECT CAST(l_shipdate AS DATE) AS ds, count(*) AS rows FROM lineitem GROUP BY 1)) WHERE rows_before IS NOT NULL""",
)
def row_count_ratio(inp: Inputs) -> DataFrame:
    return quality.row_count_ratio(inp.table("lineitem").select(F.to_date("l_shipdate").alias("ds")), "ds")
