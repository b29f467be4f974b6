"""Queries: window functions over keyed series."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockwise.functions.numeric import half_even
from stockwise.operators import series, windows as win
from stockwise.operators.accuracy import accuracy_metrics
from stockwise.plans.inputs import KEYS, Inputs, rounded, sql
from stockwise.plans.registry import query

OVER = "OVER (PARTITION BY wh_dept_id, goods_id ORDER BY ds ROWS BETWEEN"


def rounded_features(df: DataFrame) -> DataFrame:
    """Six digits on the lag columns, so that two engines compare equal."""
    lags = [c for c in df.columns if c.startswith("lag_")]
    return df.withColumns({c: half_even(F.col(c), 6) for c in lags})


def feature_sql(windows: tuple[int, ...], parts: bool = True) -> str:
    columns = ["wh_dept_id", "goods_id", "ds", "y"]
    if parts:
        columns += [
            "CAST(year(ds) AS INTEGER) AS year", "CAST(month(ds) AS INTEGER) AS month", "CAST(day(ds) AS INTEGER) AS day",
            "CAST(isodow(ds) - 1 AS INTEGER) AS day_of_week", "CAST(weekofyear(ds) AS INTEGER) AS week_of_year",
        ]
    for w in windows:
        frame = f"{OVER} {w} PRECEDING AND 1 PRECEDING)"
        calls = {"mean": "avg"} if w == 1 else {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
        columns += [f"{rounded(f'{fn}(y) {frame}', 6)} AS lag_{w}_{name}" for name, fn in calls.items()]
    return f"SELECT {', '.join(columns)} FROM daily_demand"


@query("lag_features_daily", sql("daily_demand", feature_sql(win.DAY_WINDOWS)))
def lag_features_daily(inp: Inputs) -> DataFrame:
    return rounded_features(win.lag_features(inp.daily_demand, KEYS, "ds", "y"))


WHOLE = "CAST(round_even(abs(predict_demand - y) * 1e6, 0) AS HUGEINT)"
BASELINE_ACCURACY = sql(
    "evaluated",
    f"SELECT wh_dept_id, goods_id, MSE, MAE, MAPE, {rounded('1 - MAPE', 4)} AS ACC FROM m",
    m=f"""SELECT wh_dept_id, goods_id, {rounded(f'CAST(sum({WHOLE} * {WHOLE}) AS DOUBLE) / count(*) / 1e12', 4)} AS MSE,
             {rounded(f'CAST(sum({WHOLE}) AS DOUBLE) / count(*) / 1e6', 4)} AS MAE,
             {rounded('avg(abs(predict_demand - y) / greatest(abs(y), 2.220446049250313e-16))', 4)} AS MAPE
          FROM evaluated WHERE model = 'window_7' GROUP BY 1, 2""",
)


@query("baseline_accuracy", BASELINE_ACCURACY)
def baseline_accuracy(inp: Inputs) -> DataFrame:
    week = inp.evaluated.where(F.col("model") == "window_7")
    return accuracy_metrics(week, [], {"wh_goods": KEYS}, "y", "predict_demand").drop("grain")


def grain_demand(inp: Inputs, grain: str) -> DataFrame:
    return series.demand_series(inp.sold_rows, KEYS, "ds", "qty", grain)


def grain_feature_sql(grain: str, windows: tuple[int, ...]) -> str:
    body = feature_sql(windows, parts=False).replace("FROM daily_demand", "FROM coarse")
    return sql(
        "sold_rows", body,
        coarse=f"SELECT CAST(date_trunc('{grain}', ds) AS DATE) AS ds, wh_dept_id, goods_id, sum(abs(qty)) AS y FROM sold_rows GROUP BY 1, 2, 3",
    )


@query("lag_features_week", grain_feature_sql("week", win.WEEK_WINDOWS))
def lag_features_week(inp: Inputs) -> DataFrame:
    return rounded_features(win.lag_features(grain_demand(inp, "week"), KEYS, "ds", "y", win.WEEK_WINDOWS, False))


@query("lag_features_month", grain_feature_sql("month", win.MONTH_WINDOWS))
def lag_features_month(inp: Inputs) -> DataFrame:
    return rounded_features(win.lag_features(grain_demand(inp, "month"), KEYS, "ds", "y", win.MONTH_WINDOWS, False))


@query(
    "latest_feature_slice",
    sql("daily_demand", f"""SELECT wh_dept_id, goods_id, ds, y, {rounded("m7", 6)} AS lag_7_mean, {rounded("m30", 6)} AS lag_30_mean FROM (
      SELECT *, avg(y) {OVER} 7 PRECEDING AND 1 PRECEDING) AS m7, avg(y) {OVER} 30 PRECEDING AND 1 PRECEDING) AS m30 FROM daily_demand)
      WHERE ds = (SELECT max(ds) FROM daily_demand)"""),
)
def latest_feature_slice(inp: Inputs) -> DataFrame:
    feats = win.trailing_means(inp.daily_demand, KEYS, "ds", "y", (7, 30))
    return rounded_features(win.newest_slice(feats, "ds"))


@query(
    "fwd_mean_7",
    sql("wh_demand", f"SELECT wh_dept_id, goods_id, ds, {rounded(f'avg(y) {OVER} CURRENT ROW AND 6 FOLLOWING)', 6)} AS pred_consume_mean FROM wh_demand"),
)
def fwd_mean_7(inp: Inputs) -> DataFrame:
    ahead = win.forward_mean(inp.wh_demand, KEYS, "ds", "y", 7, "pred_consume_mean")
    return ahead.select(*KEYS, "ds", half_even(F.col("pred_consume_mean"), 6).alias("pred_consume_mean"))


@query(
    "fwd_sum_dynamic",
    sql("wh_demand", """SELECT wh_dept_id, goods_id, ds, CASE WHEN rn + n - 1 <= rows THEN coalesce(total, 0) ELSE 0 END AS lt_consume FROM (
      SELECT a.*, (SELECT sum(b.y) FROM numbered b WHERE b.wh_dept_id = a.wh_dept_id AND b.goods_id = a.goods_id
                   AND b.rn BETWEEN a.rn AND a.rn + a.n - 1) AS total FROM numbered a)""",
        numbered="""SELECT *, row_number() OVER (PARTITION BY wh_dept_id, goods_id ORDER BY ds) AS rn,
          count(*) OVER (PARTITION BY wh_dept_id, goods_id) AS rows, 2 + wh_dept_id AS n FROM wh_demand"""),
)
def fwd_sum_dynamic(inp: Inputs) -> DataFrame:
    ahead = win.forward_sum_dynamic(inp.wh_demand, KEYS, "ds", "y", {"lt_consume": F.col("wh_dept_id") + 2})
    return ahead.select(*KEYS, "ds", "lt_consume")


@query(
    "running_total",
    sql("daily_demand", """SELECT wh_dept_id, goods_id, ds, sum(y) OVER (PARTITION BY wh_dept_id, goods_id ORDER BY ds) AS dly_sum FROM daily_demand
      UNION ALL SELECT NULL, goods_id, ds, sum(sum(y)) OVER (PARTITION BY goods_id ORDER BY ds) FROM daily_demand GROUP BY goods_id, ds"""),
)
def running_total(inp: Inputs) -> DataFrame:
    """Running demand per warehouse and goods, and per goods over all warehouses."""
    per_key = win.running_total(inp.daily_demand, KEYS, "ds", "y", "dly_sum").drop("y")
    nation = series.daily_sum(inp.daily_demand, ["goods_id"], "ds", "y")
    nation = win.running_total(nation, ["goods_id"], "ds", "y", "dly_sum").drop("y")
    return per_key.unionByName(nation, allowMissingColumns=True)


@query(
    "last_per_key",
    """SELECT o_custkey, 'last' AS kind, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1
       UNION ALL SELECT o_custkey, 'first', arg_min(o_orderkey, (o_orderdate, o_orderkey)) FROM orders GROUP BY 1""",
)
def last_per_key(inp: Inputs) -> DataFrame:
    orders = inp.table("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    last = win.last_rows(orders, ["o_custkey"], "o_orderdate", "o_orderkey").withColumn("kind", F.lit("last"))
    first = win.top_rows(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).withColumn("kind", F.lit("first"))
    return last.unionByName(first).select("o_custkey", "kind", "o_orderkey")


@query(
    "head_n_per_key",
    sql("daily_demand", """SELECT wh_dept_id, goods_id, ds, y FROM (SELECT *, row_number() OVER (PARTITION BY wh_dept_id, goods_id ORDER BY ds) AS rn
      FROM daily_demand) WHERE rn <= 30"""),
)
def head_n_per_key(inp: Inputs) -> DataFrame:
    return win.top_rows(inp.daily_demand, KEYS, ["ds"], 30)
