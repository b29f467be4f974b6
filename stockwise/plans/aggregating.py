"""Queries: aggregation, sorting, limits and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockwise.functions.numeric import BAND_LABELS, half_even
from stockwise.operators import aggregate as agg
from stockwise.operators import windows as win
from stockwise.plans.columns import BAND_CASE
from stockwise.plans.inputs import KEYS, Inputs, rounded, sql
from stockwise.plans.registry import query


@query("agg_sum", sql("sold_rows", f"SELECT wh_dept_id, goods_id, ds, sum(qty) AS qty, {rounded('sum(money)', 2)} AS money FROM sold_rows GROUP BY 1, 2, 3"))
def agg_sum(inp: Inputs) -> DataFrame:
    return inp.sold_by_day.groupBy(*KEYS, "ds").agg(F.sum("qty").alias("qty"), half_even(F.sum("money"), 2).alias("money"))


@query(
    "agg_basic",
    sql("daily_demand", f"""SELECT wh_dept_id, goods_id, count(*) AS size, {rounded('avg(y)', 6)} AS mean, min(y) AS lowest, max(y) AS highest
      FROM daily_demand GROUP BY 1, 2"""),
)
def agg_basic(inp: Inputs) -> DataFrame:
    return inp.daily_demand.groupBy(*KEYS).agg(
        F.count("*").alias("size"), half_even(F.avg("y"), 6).alias("mean"), F.min("y").alias("lowest"), F.max("y").alias("highest")
    )


@query(
    "agg_median",
    sql("sold_rows", """SELECT wh_dept_id, goods_id, make_timestamp(CAST(median(epoch(ds)) * 1000000 AS BIGINT)) AS median_day,
      CAST(median(CAST(shop_type_flg = 'new_shop' AS INTEGER)) > 0.5 AS BIGINT) AS mostly_new FROM sold_rows GROUP BY 1, 2"""),
)
def agg_median(inp: Inputs) -> DataFrame:
    flag = (F.col("shop_type_flg") == "new_shop").cast("int")
    return inp.sold_rows.groupBy(*KEYS).agg(
        agg.median_day("ds").alias("median_day"), (F.median(flag) > 0.5).cast("long").alias("mostly_new")
    )


@query(
    "unit_price",
    sql("sold_rows", f"""SELECT wh_dept_id, goods_id, {rounded('sum(money) / sum(qty)', 4)} AS unit_price FROM sold_rows
      WHERE ds >= (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem) - 180 AND qty > 0 AND type_flg = 'norm' GROUP BY 1, 2"""),
)
def unit_price(inp: Inputs) -> DataFrame:
    rows = inp.sold_rows.where(F.col("type_flg") == "norm")
    run_day = inp.table("lineitem").select(F.max(F.to_date("l_shipdate"))).scalar()
    price = agg.weighted_price(rows, KEYS, "money", "qty", "ds", run_day, 180)
    return price.withColumn("unit_price", half_even(F.col("unit_price"), 4))


@query(
    "cost_share",
    sql("sold_rows", f"""SELECT wh_dept_id, goods_id, 'cmdty' AS part_kind, cmdty_id AS part, sum(qty) AS part_cost,
        sum(sum(qty)) OVER g AS group_cost, {rounded('sum(qty) / sum(sum(qty)) OVER g', 2)} AS ratio
      FROM sold_rows GROUP BY 1, 2, 4 WINDOW g AS (PARTITION BY wh_dept_id, goods_id)
      UNION ALL SELECT wh_dept_id, goods_id, 'type', type_flg, sum(qty), sum(sum(qty)) OVER g, {rounded('sum(qty) / sum(sum(qty)) OVER g', 2)}
      FROM sold_rows GROUP BY 1, 2, 4 WINDOW g AS (PARTITION BY wh_dept_id, goods_id)"""),
)
def cost_share(inp: Inputs) -> DataFrame:
    by_cmdty = agg.cost_shares(inp.sold_rows, KEYS, "cmdty_id", "qty").withColumnRenamed("cmdty_id", "part")
    by_type = agg.cost_shares(inp.sold_rows, KEYS, "type_flg", "qty").withColumnRenamed("type_flg", "part")
    both = by_cmdty.withColumn("part_kind", F.lit("cmdty")).unionByName(by_type.withColumn("part_kind", F.lit("type")))
    return both.select(*KEYS, "part_kind", "part", "part_cost", "group_cost", "ratio")


@query("agg_distinct", sql("sold_rows", "SELECT wh_dept_id, count(DISTINCT goods_id) AS goods, count(DISTINCT ds) AS days, count(DISTINCT cmdty_id) AS cmdty FROM sold_rows GROUP BY 1"))
def agg_distinct(inp: Inputs) -> DataFrame:
    return inp.sold_rows.groupBy("wh_dept_id").agg(
        F.count_distinct("goods_id").alias("goods"), F.count_distinct("ds").alias("days"), F.count_distinct("cmdty_id").alias("cmdty")
    )


@query("agg_having", "SELECT o_custkey, count(*) AS shop_nums, max(o_totalprice) AS top FROM orders GROUP BY 1 HAVING count(*) > 12")
def agg_having(inp: Inputs) -> DataFrame:
    counted = inp.table("orders").groupBy("o_custkey").agg(F.count("*").alias("shop_nums"), F.max("o_totalprice").alias("top"))
    return counted.where(F.col("shop_nums") > 12)


@query(
    "multi_grain_rollup",
    sql("evaluated", f"""SELECT model, wh_dept_id, goods_id, CASE WHEN grouping(goods_id) = 1 THEN 'all' WHEN grouping(wh_dept_id) = 1 THEN 'goods' ELSE 'wh_goods' END AS grain,
      sum(y) AS y, {rounded('sum(predict_demand)', 1)} AS pred, count(*) AS n FROM evaluated
      GROUP BY GROUPING SETS ((model, wh_dept_id, goods_id), (model, goods_id), (model))"""),
)
def multi_grain_rollup(inp: Inputs) -> DataFrame:
    grains = {"wh_goods": ["wh_dept_id", "goods_id"], "goods": ["goods_id"], "all": []}
    measures = [F.sum("y").alias("y"), half_even(F.sum("predict_demand"), 1).alias("pred"), F.count("*").alias("n")]
    return agg.multi_grain(inp.evaluated, ["model"], grains, measures)


@query(
    "filtered_agg",
    sql("sold_rows", f"""SELECT large_class_name, sum(qty) AS qty, sum(qty) FILTER (WHERE type_flg = 'norm') AS qty_norm,
      {rounded('avg(qty) FILTER (WHERE type_flg = ' + "'norm'" + ')', 6)} AS mean_norm FROM sold_rows GROUP BY 1"""),
)
def filtered_agg(inp: Inputs) -> DataFrame:
    norm = F.when(F.col("type_flg") == "norm", F.col("qty"))
    return inp.sold_rows.groupBy("large_class_name").agg(
        F.sum("qty").alias("qty"), F.sum(norm).alias("qty_norm"), half_even(F.avg(norm), 6).alias("mean_norm")
    )


BAND_COUNTS = ", ".join(f"CAST(count(*) FILTER (WHERE band = '{b}') AS BIGINT) AS {b}" for b in BAND_LABELS)
BAND_RATIOS = ", ".join(f"{rounded(f'{b} / total', 4)} AS {b}_ratio" for b in BAND_LABELS)


@query(
    "band_ratio",
    sql("evaluated", f"""SELECT *, {BAND_RATIOS} FROM (
      SELECT model, wh_dept_id, CASE WHEN grouping(wh_dept_id) = 1 THEN 'model' ELSE 'model_wh' END AS grain, count(*) AS total, {BAND_COUNTS}
      FROM (SELECT *, {BAND_CASE} AS band FROM (SELECT *, abs(predict_demand - y) / y AS err FROM evaluated))
      GROUP BY GROUPING SETS ((model), (model, wh_dept_id)))"""),
)
def band_ratio(inp: Inputs) -> DataFrame:
    err = F.abs(F.col("predict_demand") - F.col("y")) / F.col("y")
    return agg.band_ratios(inp.evaluated, ["model"], {"model": [], "model_wh": ["wh_dept_id"]}, err)


@query(
    "dedup_max",
    sql("forecast", """SELECT predict_dt, wh_dept_id, goods_id, max(predict_demand) AS predict_demand FROM (
      SELECT * FROM forecast WHERE model = 'window_7' UNION ALL SELECT * FROM forecast WHERE model = 'window_14') GROUP BY 1, 2, 3"""),
)
def dedup_max(inp: Inputs) -> DataFrame:
    """Two overlapping groups of forecasts; the larger value stands for a key and day."""
    groups = [inp.forecast.where(F.col("model") == m) for m in ("window_7", "window_14")]
    return groups[0].unionByName(groups[1]).groupBy("predict_dt", *KEYS).agg(F.max("predict_demand").alias("predict_demand"))


@query(
    "pivot_weeks",
    sql("wh_demand", "SELECT goods_id, " + ", ".join(f"sum(y) FILTER (WHERE week = 'W{k}') AS W{k}" for k in (1, 2, 3, 4))
        + " FROM (SELECT *, 'W' || CAST((dayofyear(ds) - 1) // 7 + 1 AS VARCHAR) AS week FROM wh_demand) GROUP BY 1"),
)
def pivot_weeks(inp: Inputs) -> DataFrame:
    week = F.concat(F.lit("W"), F.floor((F.dayofyear("ds") - 1) / 7 + 1).cast("string"))
    return agg.pivot_labels(inp.wh_demand.withColumn("week", week), ["goods_id"], "week", ["W1", "W2", "W3", "W4"], F.sum("y"))


@query("sort_multi", "SELECT o_orderpriority, o_totalprice, o_orderkey FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey")
def sort_multi(inp: Inputs) -> DataFrame:
    return inp.table("orders").select("o_orderpriority", "o_totalprice", "o_orderkey").orderBy(
        "o_orderpriority", F.desc("o_totalprice"), "o_orderkey"
    )


@query(
    "top_k",
    """SELECT o_custkey, income FROM (SELECT o_custkey, round_even(sum(o_totalprice) * 1e2, 0) / 1e2 AS income FROM orders GROUP BY 1)
       ORDER BY income DESC, o_custkey LIMIT 20""",
)
def top_k(inp: Inputs) -> DataFrame:
    income = inp.table("orders").groupBy("o_custkey").agg(half_even(F.sum("o_totalprice"), 2).alias("income"))
    return income.orderBy(F.desc("income"), "o_custkey").limit(20)


@query(
    "union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def union_by_name(inp: Inputs) -> DataFrame:
    customer = inp.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    supplier = inp.table("supplier").select(F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return customer.unionByName(supplier, allowMissingColumns=True)


@query("set_except", "SELECT DISTINCT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def set_except(inp: Inputs) -> DataFrame:
    ordered = inp.table("orders").where(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("c_custkey"))
    return inp.table("customer").select("c_custkey").subtract(ordered)


@query(
    "ledger_union_sum",
    """SELECT dt, wh_dept_id, sum(transit) AS transit FROM (
         SELECT CAST(o_orderdate AS DATE) AS dt, o_custkey % 5 AS wh_dept_id, 10e0 AS transit FROM orders
         UNION ALL SELECT CAST(l_shipdate AS DATE), l_suppkey % 5, l_quantity FROM lineitem) GROUP BY 1, 2""",
)
def ledger_union_sum(inp: Inputs) -> DataFrame:
    planned = inp.table("orders").select(
        F.to_date("o_orderdate").alias("dt"), (F.col("o_custkey") % 5).alias("wh_dept_id"), F.lit(10.0).alias("transit")
    )
    real = inp.table("lineitem").select(
        F.to_date("l_shipdate").alias("dt"), (F.col("l_suppkey") % 5).alias("wh_dept_id"), F.col("l_quantity").alias("transit")
    )
    return planned.unionByName(real).groupBy("dt", "wh_dept_id").agg(F.sum("transit").alias("transit"))
