"""Queries: reads and writes of partitioned datasets, warehouse SQL, published marts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from stockwise.functions.numeric import half_even
from stockwise.operators import windows as win
from stockwise.plans.inputs import KEYS, Inputs, rounded, sql
from stockwise.plans.registry import query
from stockwise.plans.windowing import rounded_features
from stockwise.session import work_path
from stockwise.sources import readers, sinks

EVENTS = """SELECT user_id % 5 AS wh_dept_id, event_id % 5 AS goods_id, event_id, value, CAST(ts AS DATE) AS dt,
  lpad(CAST(hour(ts) // 6 * 6 AS VARCHAR), 2, '0') AS hm, event_type FROM events"""


def events_by_day(inp: Inputs) -> DataFrame:
    return inp.table("events").select(
        (F.col("user_id") % 5).alias("wh_dept_id"),
        (F.col("event_id") % 5).alias("goods_id"),
        "event_id",
        "value",
        F.to_date("ts").alias("dt"),
        F.lpad((F.floor(F.hour("ts") / 6) * 6).cast("string"), 2, "0").alias("hm"),
        "event_type",
    )


def stored_events(inp: Inputs) -> str:
    path = work_path(inp.spark, "events")
    sinks.write_days(events_by_day(inp), path)
    return path


@query(
    "scan_dt_range",
    sql("", "SELECT wh_dept_id, goods_id, event_id, value, dt FROM e WHERE dt BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'", e=EVENTS),
)
def scan_dt_range(inp: Inputs) -> DataFrame:
    df = readers.read_days(inp.spark, stored_events(inp), "2024-01-05", "2024-01-20")
    return df.select("wh_dept_id", "goods_id", "event_id", "value", "dt")


@query(
    "scan_latest_per_key",
    sql("", """SELECT wh_dept_id, goods_id, event_id, value, dt FROM (
      SELECT *, row_number() OVER (PARTITION BY wh_dept_id, goods_id ORDER BY dt DESC, event_id DESC) AS rn FROM e) WHERE rn = 1""", e=EVENTS),
)
def scan_latest_per_key(inp: Inputs) -> DataFrame:
    df = readers.read_latest_per_key(inp.spark, stored_events(inp), KEYS, "event_id")
    return df.select("wh_dept_id", "goods_id", "event_id", "value", "dt")


@query(
    "scan_csv_parquet",
    """SELECT c.c_custkey, c.c_mktsegment, c.c_acctbal, n.n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def scan_csv_parquet(inp: Inputs) -> DataFrame:
    path = work_path(inp.spark, "customer-csv")
    columns = ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"]
    inp.table("customer").select(*columns).write.csv(path, header=True)
    text = readers.read_file(inp.spark, path, "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string")
    nation = readers.read_file(inp.spark, f"{inp.sf_dir}/nation.parquet")
    joined = text.join(nation, text.c_nationkey == nation.n_nationkey)
    return joined.select("c_custkey", "c_mktsegment", "c_acctbal", "n_name")


@query(
    "scan_latest_snapshot",
    sql("", """SELECT event_id, value, dt, hm FROM e WHERE dt = DATE '2024-01-20'
      AND hm = (SELECT max(hm) FROM e WHERE dt = DATE '2024-01-20')""", e=EVENTS),
)
def scan_latest_snapshot(inp: Inputs) -> DataFrame:
    path = work_path(inp.spark, "snapshots")
    events_by_day(inp).hint("rebalance", "dt", "hm").write.partitionBy("dt", "hm").parquet(path)
    # Read as text: the folder names would otherwise lose the leading zero of the hour.
    df = inp.spark.read.schema("event_id bigint, value double, dt date, hm string").parquet(path)
    return readers.latest_snapshot(df, "2024-01-20").select("event_id", "value", "dt", "hm")


WAREHOUSE_SQL = """
    SELECT s.wh_dept_id, s.goods_id, s.last_dt, sum(s.qty) AS qty, count(DISTINCT s.cmdty_id) AS cmdty_cnt
    FROM (SELECT *, (SELECT max(ds) FROM sold_rows) AS last_dt FROM sold_rows) s
    WHERE (s.large_class_name IN ('ECONOMY', 'PROMO') OR (s.large_class_name = 'SMALL' AND s.shop_type_flg = 'norm_shop'))
      AND s.qty > 0 AND s.goods_id IN (SELECT DISTINCT goods_id FROM sold_rows WHERE type_flg = 'norm')
    GROUP BY s.wh_dept_id, s.goods_id, s.last_dt"""


@query("warehouse_sql", sql("sold_rows", WAREHOUSE_SQL))
def warehouse_sql(inp: Inputs) -> DataFrame:
    """The same SELECT text with IN, OR, DISTINCT, subqueries and GROUP BY, run by Spark SQL."""
    return inp.spark.sql(WAREHOUSE_SQL.replace("sold_rows", "{sold}"), sold=inp.sold_rows)


@query(
    "dim_extract_distinct",
    """SELECT DISTINCT CAST(c_custkey % 50 AS INTEGER) AS shop_dept_id, CAST(c_nationkey AS INTEGER) AS city_id,
         coalesce(CAST(floor(nullif(c_acctbal, 0)) AS INTEGER) % 7, 0) AS use_day, c_mktsegment AS shop_type_name FROM customer""",
)
def dim_extract_distinct(inp: Inputs) -> DataFrame:
    balance = F.nullif(F.col("c_acctbal"), F.lit(0.0))
    dim = inp.table("customer").select(
        (F.col("c_custkey") % 50).cast("int").alias("shop_dept_id"),
        F.col("c_nationkey").cast("int").alias("city_id"),
        (F.floor(balance).cast("int") % 7).alias("use_day"),
        F.col("c_mktsegment").alias("shop_type_name"),
    )
    return dim.fillna({"use_day": 0}).distinct()


@query(
    "partition_fallback",
    sql("", """SELECT event_id, value, dt FROM e WHERE dt = (SELECT max(dt) FROM e WHERE dt <= DATE '2024-02-03')""", e=EVENTS),
)
def partition_fallback(inp: Inputs) -> DataFrame:
    """The run day has no rows yet, so the last earlier day stands in."""
    df = readers.latest_available(readers.read_days(inp.spark, stored_events(inp)), "2024-02-03")
    return df.select("event_id", "value", "dt")


@query("read_or_compute", sql("", "SELECT wh_dept_id, goods_id, dt, count(*) AS n FROM e GROUP BY 1, 2, 3", e=EVENTS))
def read_or_compute(inp: Inputs) -> DataFrame:
    """Computed and stored at the first call, read back at the second."""
    path = work_path(inp.spark, "cached")

    def compute() -> DataFrame:
        return events_by_day(inp).groupBy(*KEYS, "dt").agg(F.count("*").alias("n"))

    readers.read_or_compute(inp.spark, path, compute)
    return readers.read_or_compute(inp.spark, path, compute)


@query(
    "sink_contract",
    sql("forecast", f"""SELECT strftime(predict_dt, '%Y-%m-%d') AS predict_dt, wh_dept_id, goods_id, 'window_7' AS model,
      {rounded('predict_demand', 1)} AS predict_demand, dt FROM forecast WHERE model = 'window_7'"""),
)
def sink_contract(inp: Inputs) -> DataFrame:
    path = work_path(inp.spark, "forecast")
    rows = inp.forecast.where(F.col("model") == "window_7")
    sinks.write_days(sinks.apply_contract(rows, sinks.FORECAST), path)
    return readers.read_days(inp.spark, path).select(*sinks.FORECAST)


@query(
    "hive_partition_sink",
    sql("", "SELECT dt, wh_dept_id, goods_id, CAST(count(*) AS BIGINT) AS n, round_even(sum(value) * 1e2, 0) / 1e2 AS total FROM e GROUP BY 1, 2, 3", e=EVENTS),
)
def hive_partition_sink(inp: Inputs) -> DataFrame:
    """A partitioned table in the warehouse, written twice: the second write replaces its days only."""
    daily = events_by_day(inp).groupBy("dt", *KEYS).agg(
        F.count("*").alias("n"), half_even(F.sum("value"), 2).alias("total")
    )
    table = f"mart_{uuid.uuid4().hex}"
    sinks.write_table(daily, table)
    sinks.write_table(daily.where(F.col("dt") >= F.lit("2024-01-25").cast("date")), table)
    return inp.spark.table(table).select("dt", *KEYS, "n", "total")


@query(
    "feature_backfill",
    sql("wh_demand", f"""SELECT *, ds AS dt FROM (SELECT wh_dept_id, goods_id, ds, y,
      {rounded("avg(y) OVER (PARTITION BY wh_dept_id, goods_id ORDER BY ds ROWS BETWEEN 1 PRECEDING AND 1 PRECEDING)", 6)} AS lag_1_mean,
      {rounded("avg(y) OVER (PARTITION BY wh_dept_id, goods_id ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)", 6)} AS lag_7_mean
      FROM wh_demand) WHERE ds >= DATE '2024-01-10'"""),
)
def feature_backfill(inp: Inputs) -> DataFrame:
    feats = rounded_features(win.trailing_means(inp.wh_demand, KEYS, "ds", "y", (1, 7)))
    path = work_path(inp.spark, "features")
    sinks.backfill(feats, path, "ds", "2024-01-10")
    return readers.read_days(inp.spark, path).select(*KEYS, "ds", "y", "lag_1_mean", "lag_7_mean", "dt")


@query(
    "publish_future_pred",
    sql("store_plan", """SELECT dt AS date, CAST(version_id AS BIGINT) AS plan_id, CAST(goods_id AS BIGINT) AS commodity_id, dept_id,
      pred_consume AS pred, CAST(1 - closed AS BIGINT) AS open FROM
      (SELECT *, 'W' || CAST((dayofyear(dt) - 1) // 7 AS VARCHAR) AS week_label FROM store_plan) WHERE week_label <> 'W0'"""),
)
def publish_future_pred(inp: Inputs) -> DataFrame:
    week = F.concat(F.lit("W"), F.floor((F.dayofyear("dt") - 1) / 7).cast("string"))
    return (
        inp.store_plan.withColumn("week_label", week)
        .withColumnsRenamed({"dt": "date", "version_id": "plan_id", "goods_id": "commodity_id", "pred_consume": "pred"})
        .where(F.col("week_label") != "W0")
        .select("date", "plan_id", "commodity_id", "dept_id", "pred", (1 - F.col("closed")).cast("long").alias("open"))
    )
