"""Queries: joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockwise.operators import joins
from stockwise.plans.inputs import HORIZON, KEYS, Inputs, sql
from stockwise.plans.registry import query


@query("join_inner", """SELECT l_orderkey, l_linenumber, l_quantity, o_custkey, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def join_inner(inp: Inputs) -> DataFrame:
    line, orders = inp.table("lineitem"), inp.table("orders")
    joined = line.join(orders, line.l_orderkey == orders.o_orderkey)
    return joined.select("l_orderkey", "l_linenumber", "l_quantity", "o_custkey", "o_orderstatus")


@query(
    "join_left",
    sql("evaluated", """SELECT f.model, f.dt AS dt_x, f.predict_dt, f.wh_dept_id, f.goods_id, f.predict_demand, d.y AS theory_sale_cnt
      FROM forecast f LEFT JOIN daily_demand d ON f.predict_dt = d.ds AND f.wh_dept_id = d.wh_dept_id AND f.goods_id = d.goods_id"""),
)
def join_left(inp: Inputs) -> DataFrame:
    """Left join over differently named day columns; both sides have a ``dt``, so one is renamed."""
    actual = inp.actual.select(F.col("ds").alias("dt"), *KEYS, F.col("y").alias("theory_sale_cnt")).alias("a")
    pred = inp.forecast_by_day.alias("p")
    on = (F.col("p.predict_dt") == F.col("a.dt")) & (F.col("p.wh_dept_id") == F.col("a.wh_dept_id")) & (F.col("p.goods_id") == F.col("a.goods_id"))
    return pred.join(actual, on, "left").select(
        "p.model", F.col("p.dt").alias("dt_x"), "p.predict_dt", "p.wh_dept_id", "p.goods_id", "p.predict_demand", "a.theory_sale_cnt"
    )


@query(
    "join_outer_fill",
    """SELECT coalesce(a.dept_id, b.dept_id) AS dept_id, coalesce(a.goods_id, b.goods_id) AS goods_id, coalesce(ss, 0e0) AS ss, coalesce(ro, 0e0) AS ro
       FROM (SELECT o_custkey AS dept_id, o_orderstatus AS goods_id, CAST(count(*) AS DOUBLE) AS ss FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2) a
       FULL JOIN (SELECT o_custkey AS dept_id, o_orderstatus AS goods_id, CAST(count(*) AS DOUBLE) AS ro FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1, 2) b
       ON a.dept_id = b.dept_id AND a.goods_id = b.goods_id""",
)
def join_outer_fill(inp: Inputs) -> DataFrame:
    orders = inp.table("orders").select(F.col("o_custkey").alias("dept_id"), F.col("o_orderstatus").alias("goods_id"), "o_orderpriority")
    keys = ["dept_id", "goods_id"]

    def counted(priority: str, out: str) -> DataFrame:
        return orders.where(F.col("o_orderpriority") == priority).groupBy(*keys).agg(F.count("*").cast("double").alias(out))

    return joins.outer_filled(counted("1-URGENT", "ss"), counted("5-LOW", "ro"), keys)


@query(
    "range_join_cumsum",
    sql("daily_demand", f"""SELECT a.wh_dept_id, a.goods_id, a.ds, b.ds AS predict_dt,
      sum(b.y) OVER (PARTITION BY a.wh_dept_id, a.goods_id, a.ds ORDER BY b.ds) AS cumsum
      FROM numbered a JOIN numbered b ON a.wh_dept_id = b.wh_dept_id AND a.goods_id = b.goods_id AND b.rn BETWEEN a.rn AND a.rn + {HORIZON - 1}""",
        numbered="SELECT *, row_number() OVER (PARTITION BY wh_dept_id, goods_id ORDER BY ds) AS rn FROM daily_demand"),
)
def range_join_cumsum(inp: Inputs) -> DataFrame:
    """Over the forecast horizon, like every plan that uses it."""
    return joins.later_day_sums(inp.daily_demand, KEYS, "ds", "y", HORIZON)


@query("join_semi", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def join_semi(inp: Inputs) -> DataFrame:
    urgent = inp.table("orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return inp.table("customer").select("c_custkey", "c_name").join(urgent, "c_custkey", "left_semi")


@query("join_anti", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def join_anti(inp: Inputs) -> DataFrame:
    urgent = inp.table("orders").where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("c_custkey"))
    return inp.table("customer").select("c_custkey", "c_name").join(urgent, "c_custkey", "left_anti")


@query(
    "join_broadcast_dim",
    """SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def join_broadcast_dim(inp: Inputs) -> DataFrame:
    """Dimension names; the planner broadcasts nation and region for their file size."""
    nation, region = inp.table("nation"), inp.table("region")
    names = nation.join(region, nation.n_regionkey == region.r_regionkey)
    supplier = inp.table("supplier")
    return supplier.join(names, supplier.s_nationkey == nation.n_nationkey).select("s_suppkey", "s_name", "n_name", "r_name")
