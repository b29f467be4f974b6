"""Logical input views over the test tables, once as DataFrames and once as SQL text.

The views stand for the business tables the operators work on: sold rows, daily demand,
store demand, forecasts and store plans.  ``VIEWS`` holds the same definitions for the
checking engine, and ``sql()`` joins the ones a check needs in front of its body.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockwise.functions.numeric import half_even
from stockwise.operators import forecast as fc
from stockwise.operators import series
from stockwise.operators import windows as win
from stockwise.session import staged

KEYS = ["wh_dept_id", "goods_id"]
BASELINE_WINDOWS = (1, 7, 14, 21, 28)
HORIZON = 30


def rounded(expr: str, digits: int = 0) -> str:
    """SQL text of half-even rounding on the binary value."""
    scale = f"1e{digits}"
    return f"(round_even(({expr}) * {scale}, 0) / {scale} + 0e0)"


def dense_sql(source: str, keys: str) -> str:
    """SQL text of a series with zeros on its missing days, from each key's first day to the last day of all."""
    return f"""SELECT {keys}, ds, sum(y) AS y FROM (SELECT {keys}, ds, y FROM {source} UNION ALL
      SELECT {keys}, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE), 0.0
      FROM (SELECT {keys}, min(ds) AS first_day, (SELECT max(ds) FROM {source}) AS last_day FROM {source} GROUP BY ALL)) GROUP BY ALL"""


def goods_number() -> Column:
    """Eight goods by size for every ten thousand parts, so that the number of series grows with the data."""
    return (F.col("p_size") % 8 + 8 * F.floor(F.col("p_partkey") / 10000)).cast("long")


def priced(sold: DataFrame) -> DataFrame:
    """Money per piece; the price of goods 3 in warehouse 2 is missing, so that the fallback has work."""
    missing = (F.col("wh_dept_id") == 2) & (F.col("goods_id") == 3)
    return sold.groupBy(*KEYS).agg(F.when(~missing, F.sum("money") / F.sum("qty")).alias("unit_price"))


class Inputs:
    """Lazy views for one session and one table folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = str(sf_dir).rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def line_count(self) -> int:
        return self.table("lineitem").count()

    @cached_property
    def sold_rows(self) -> DataFrame:
        """One row per sold line with warehouse, goods and population labels."""
        part = self.table("part").select("p_partkey", "p_size", "p_brand", "p_type")
        line = self.table("lineitem")
        part = series.spread_for(part, "p_partkey", self.line_count)
        rows = line.join(part, line.l_partkey == part.p_partkey).select(
            (F.col("l_suppkey") % 5).alias("wh_dept_id"),
            goods_number().alias("goods_id"),
            F.to_date("l_shipdate").alias("ds"),
            F.col("l_quantity").alias("qty"),
            F.col("l_extendedprice").alias("money"),
            "l_discount",
            "l_returnflag",
            F.when(F.col("p_size") % 3 == 0, "norm").when(F.col("p_size") % 3 == 1, "subnew").otherwise("new").alias("type_flg"),
            F.when(F.col("l_linenumber") % 2 == 0, "new_shop").otherwise("norm_shop").alias("shop_type_flg"),
            F.col("p_brand").alias("cmdty_id"),
            F.col("p_type").alias("large_class_name"),
        )
        return series.present(rows, *KEYS, "ds")

    @cached_property
    def sold_by_day(self) -> DataFrame:
        """``sold_rows`` for sums by key and day."""
        return series.dealt_by(self.sold_rows, [*KEYS, "ds"], self.line_count)

    @cached_property
    def daily_demand(self) -> DataFrame:
        return series.daily_sum(self.sold_by_day, KEYS, "ds", "qty")

    @cached_property
    def unit_price(self) -> DataFrame:
        return priced(self.sold_rows)

    @cached_property
    def demand_table(self) -> DataFrame:
        """Daily demand, written once for forecasts and what came true."""
        return staged(self.daily_demand, "daily-demand")

    @cached_property
    def series_partitions(self) -> int:
        return series.series_partitions(self.demand_table, KEYS, "ds")

    @cached_property
    def forecast(self) -> DataFrame:
        """Flat moving-average forecasts from every month start over the horizon."""
        dense = series.dense_from_first(self.demand_table, KEYS, "ds", "y", partitions=self.series_partitions)
        feats = win.trailing_means(dense, KEYS, "ds", "y", BASELINE_WINDOWS)
        flat = fc.flat_baselines(feats, KEYS, "ds", BASELINE_WINDOWS, HORIZON)
        return flat.withColumn("predict_demand", half_even(F.col("predict_demand"), 1))

    @cached_property
    def actual(self) -> DataFrame:
        """Daily demand, spread like ``forecast_by_day`` to be joined with it.

        Merged, not broadcast: the written table looks small for its rows, and a broadcast one would be held whole by every task.
        """
        return self.demand_table.repartition(self.series_partitions, "ds", *KEYS).hint("merge")

    @cached_property
    def forecast_by_day(self) -> DataFrame:
        """Forecasts spread by day and key over partitions whose number grows with the series, where a join sorts them."""
        return self.forecast.repartition(self.series_partitions, "predict_dt", *KEYS)

    @cached_property
    def evaluated(self) -> DataFrame:
        """Forecast rows with the demand that came true."""
        actual = self.actual.withColumnRenamed("ds", "predict_dt")
        return self.forecast_by_day.join(actual, ["predict_dt", *KEYS])

    @cached_property
    def store_demand(self) -> DataFrame:
        """Dense store x goods x day demand in whole pieces."""
        rows = self.table("events").select(
            F.col("user_id").alias("dept_id"),
            (F.col("event_id") % 5).alias("goods_id"),
            F.to_date("ts").alias("ds"),
            half_even(F.col("value")).alias("y"),
        )
        rows = series.present(rows, "dept_id", "goods_id", "ds")
        first, last = series.time_bounds(rows, "ds")
        dense = series.densify(rows, ["dept_id", "goods_id"], "ds", "y", first, last)
        return dense.withColumn("wh_dept_id", F.col("dept_id") % 5)

    @cached_property
    def wh_demand(self) -> DataFrame:
        """Dense warehouse x goods x day demand."""
        return series.daily_sum(self.store_demand, KEYS, "ds", "y")

    @cached_property
    def store_plan(self) -> DataFrame:
        return self.plan_of(self.store_demand)

    @staticmethod
    def plan_of(demand: DataFrame) -> DataFrame:
        """Planning base: two versions, forward cover and lead-time demand, order and receive days."""
        keys = ["version_id", "dept_id", "goods_id"]
        base = demand.withColumn("version_id", F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))))
        base = base.withColumn("pred_consume", F.col("y") * F.col("version_id"))
        base = win.forward_sums(base, keys, "ds", "pred_consume", {"bp_consume": 3, "vlt_consume": 2})
        day = F.dayofyear("ds")
        return base.select(
            *keys,
            "wh_dept_id",
            F.col("ds").alias("dt"),
            "pred_consume",
            F.lit(2.0).alias("ss_ro"),
            (F.weekday("ds") == 6).cast("long").alias("closed"),
            "bp_consume",
            "vlt_consume",
            F.lit(5.0).alias("dly_use_ratio"),
            (day % 3 == 0).cast("long").alias("can_order"),
            F.date_add("ds", 2).alias("receive_day"),
            F.lit(50.0).alias("shop_beg"),
            F.when(day % 7 == 0, 10.0).otherwise(0.0).alias("expected_receive"),
        )

    @cached_property
    def store_orders(self) -> DataFrame:
        """Order quantity per warehouse, goods, month and store, with a stock that falls short."""
        group = ["wh_dept_id", "goods_id", "dt"]
        orders = (
            self.table("orders")
            .select(
                (F.col("o_custkey") % 5).alias("wh_dept_id"),
                F.col("o_orderpriority").substr(1, 1).cast("long").alias("goods_id"),
                F.trunc(F.to_date("o_orderdate"), "month").alias("dt"),
                F.col("o_custkey").alias("dept_id"),
                (10 * (1 + F.col("o_orderkey") % 7)).cast("double").alias("order_num"),
            )
            .groupBy(*group, "dept_id")
            .agg(F.sum("order_num").alias("order_num"))
            .withColumn("dly_use_ratio", F.lit(10.0))
        )
        orders = series.present(orders, *group, "dept_id")
        # One month in four has stock for everything, the rest covers six tenths.
        share = F.when(F.month("dt") % 4 == 0, 1.0).otherwise(0.6)
        totals = orders.groupBy(*group).agg(F.sum("order_num").alias("wh_order_sum"))
        return orders.join(totals.withColumn("wh_begin", F.rint(F.col("wh_order_sum") * share)), group)


VIEWS: dict[str, str] = {
    "sold_rows": """
        SELECT l_suppkey % 5 AS wh_dept_id, CAST(p_size % 8 + 8 * (p_partkey // 10000) AS BIGINT) AS goods_id, CAST(l_shipdate AS DATE) AS ds,
               l_quantity AS qty, l_extendedprice AS money, l_discount, l_returnflag,
               CASE p_size % 3 WHEN 0 THEN 'norm' WHEN 1 THEN 'subnew' ELSE 'new' END AS type_flg,
               CASE l_linenumber % 2 WHEN 0 THEN 'new_shop' ELSE 'norm_shop' END AS shop_type_flg,
               p_brand AS cmdty_id, p_type AS large_class_name
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "daily_demand": "SELECT wh_dept_id, goods_id, ds, sum(qty) AS y FROM sold_rows GROUP BY 1, 2, 3",
    "unit_price": """
        SELECT wh_dept_id, goods_id, CASE WHEN NOT (wh_dept_id = 2 AND goods_id = 3) THEN sum(money) / sum(qty) END AS unit_price
        FROM sold_rows GROUP BY 1, 2""",
    "forecast": f"""
        SELECT model, ds AS dt, CAST(ds + CAST(step AS INTEGER) AS DATE) AS predict_dt, wh_dept_id, goods_id,
               {rounded("pred", 1)} AS predict_demand
        FROM (
          SELECT *, unnest([{", ".join(f"'window_{w}'" for w in BASELINE_WINDOWS)}]) AS model,
                 unnest([{", ".join(f"m{w}" for w in BASELINE_WINDOWS)}]) AS pred
          FROM (SELECT *, {", ".join(f"avg(y) OVER (PARTITION BY wh_dept_id, goods_id ORDER BY ds ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) AS m{w}" for w in BASELINE_WINDOWS)}
                FROM ({dense_sql("daily_demand", "wh_dept_id, goods_id")}))
          WHERE day(ds) = 1), range(0, {HORIZON}) steps(step)
        WHERE pred IS NOT NULL""",
    "evaluated": "SELECT f.*, d.y FROM forecast f JOIN daily_demand d ON f.predict_dt = d.ds AND f.wh_dept_id = d.wh_dept_id AND f.goods_id = d.goods_id",
    "store_demand": """
        SELECT dept_id, goods_id, ds, sum(y) AS y, dept_id % 5 AS wh_dept_id FROM (
          SELECT user_id AS dept_id, event_id % 5 AS goods_id, CAST(ts AS DATE) AS ds, round_even(value, 0) AS y FROM events
          UNION ALL
          SELECT k.dept_id, k.goods_id, CAST(c.d AS DATE), 0.0
          FROM (SELECT DISTINCT user_id AS dept_id, event_id % 5 AS goods_id FROM events) k,
               (SELECT unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS d FROM events) c)
        GROUP BY 1, 2, 3""",
    "wh_demand": "SELECT wh_dept_id, goods_id, ds, sum(y) AS y FROM store_demand GROUP BY 1, 2, 3",
    "store_plan": """
        SELECT version_id, dept_id, goods_id, wh_dept_id, ds AS dt, pred_consume, 2e0 AS ss_ro,
               CAST(isodow(ds) = 7 AS BIGINT) AS closed,
               sum(pred_consume) OVER (w ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS bp_consume,
               sum(pred_consume) OVER (w ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS vlt_consume,
               5e0 AS dly_use_ratio, CAST(dayofyear(ds) % 3 = 0 AS BIGINT) AS can_order, CAST(ds + 2 AS DATE) AS receive_day,
               50e0 AS shop_beg, CASE WHEN dayofyear(ds) % 7 = 0 THEN 10e0 ELSE 0e0 END AS expected_receive
        FROM (SELECT v.version_id, s.*, s.y * v.version_id AS pred_consume
              FROM store_demand s, (SELECT unnest([1::BIGINT, 2::BIGINT]) AS version_id) v)
        WINDOW w AS (PARTITION BY version_id, dept_id, goods_id ORDER BY ds)""",
    "store_orders": """
        SELECT o.*, sum(order_num) OVER g AS wh_order_sum,
               round_even(sum(order_num) OVER g * CASE WHEN month(dt) % 4 = 0 THEN 1e0 ELSE 0.6e0 END, 0) AS wh_begin
        FROM (SELECT o_custkey % 5 AS wh_dept_id, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS goods_id,
                     CAST(date_trunc('month', o_orderdate) AS DATE) AS dt, o_custkey AS dept_id,
                     CAST(sum(10 * (1 + o_orderkey % 7)) AS DOUBLE) AS order_num, 10e0 AS dly_use_ratio
              FROM orders GROUP BY ALL) o
        WINDOW g AS (PARTITION BY wh_dept_id, goods_id, dt)""",
}

_NEEDS = {
    "daily_demand": ["sold_rows"],
    "unit_price": ["sold_rows"],
    "forecast": ["daily_demand"],
    "evaluated": ["forecast"],
    "wh_demand": ["store_demand"],
    "store_plan": ["store_demand"],
}


def _resolve(names: list[str]) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in _NEEDS.get(name, []):
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def sql(views: str, body: str, recursive: bool = False, **named: str) -> str:
    """SQL text with the named views (and further ones given as keywords) in front of ``body``."""
    parts = {name: VIEWS[name] for name in _resolve(views.split())}
    parts.update(named)
    if not parts:
        return body
    heads = []
    for name, text in parts.items():
        heads.append(f"{name} AS ({text})")
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(heads) + f"\n{body}"
