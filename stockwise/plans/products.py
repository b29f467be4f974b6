"""Queries: supply marts of new and recently launched products, from orders to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stockwise.operators import products as pro
from stockwise.operators import replenish as rep
from stockwise.plans.inputs import KEYS, Inputs, rounded, sql
from stockwise.plans.planning import NUMBERED, REORDERED
from stockwise.plans.registry import query
from stockwise.session import staged
from stockwise.sources import sinks

#: The version whose orders are stocked up; both versions consume.
STOCK_UP = 1
TAGS = {"material_type": 1, "stock_up_version": STOCK_UP, "strategy_version_id": 7, "sim_version": 3}
TAGS_SQL = "1::INTEGER AS material_type, 1::INTEGER AS stock_up_version, 7::INTEGER AS strategy_version_id, 3::INTEGER AS sim_version"


class Launched:
    """Orders, consumption and terms of the launched goods, from the store plan."""

    def __init__(self, inp: Inputs):
        plan = staged(inp.plan_of(staged(inp.store_demand, "store-demand")), "store-plan")
        keys = ["version_id", "goods_id", "wh_dept_id", "dt"]
        placed = rep.reorder_plan(plan, ["version_id", "dept_id", "goods_id"]).withColumn("wh_dept_id", F.col("dept_id") % 5)
        self.orders = staged(placed.groupBy(*keys).agg(F.sum("order_num").alias("order_num")), "orders")
        self.stocked = self.orders.where(F.col("version_id") == STOCK_UP).drop("version_id")
        self.outflow = self.orders.groupBy("version_id", "goods_id", "dt").agg(F.sum("order_num").alias("theory_order_sum"))
        self.first, self.last = (plan.select(f("dt")).scalar() for f in (F.min, F.max))
        # One launch day for all stores, launches within a week, launches over three weeks.
        spread = F.when(F.col("goods_id") % 3 == 0, 1).when(F.col("goods_id") % 3 == 1, 6).otherwise(20)
        launch = F.date_add(self.first, (2 + F.col("dept_id") % spread).cast("int"))
        self.launches = plan.select("goods_id", "dept_id").distinct().select("goods_id", launch.alias("launch"))
        pairs = plan.select(*KEYS).distinct()
        self.terms = pairs.withColumns(
            {
                "wh_bp": F.lit(3), "wh_lt": F.col("wh_dept_id") % 2, "pt": F.lit(5), "mt": F.lit(7), "pur_use_ratio": F.lit(60.0),
                "vlt_po": F.lit(2), "second_bp_po": 1 + F.col("wh_dept_id") % 3, "ss_po": F.lit(4),
            }
        )
        self.goods = plan.select("goods_id").distinct().withColumns(
            {
                "supplier_stock": (10 + F.col("goods_id")).cast("double"),
                "expire_day": F.date_add(self.first, (8 * (F.col("goods_id") + 1)).cast("int")),
                "avg_needs": 1.5 + 0.1 * F.col("goods_id"),
                "po_total": 200.0 * (1 + F.col("goods_id")),
            }
        )
        week = F.concat(F.lit("w"), F.floor((F.dayofyear("dt") - 1) / 7 + 1).cast("string"))
        self.portions = pro.weekly_portions(plan.withColumn("week", week), self.goods.select("goods_id", "avg_needs"))
        # Stock and arrivals of every second warehouse; the others have none.
        even = F.col("wh_dept_id") % 2 == 0
        self.stock = pairs.where(even).withColumn("beg_wh_stock", 90.0 * (1 + F.col("goods_id") % 2))
        self.arriving = pairs.where(~even).withColumn("cg_zt", F.lit(150.0))


LAUNCHED = {
    "numbered": NUMBERED,
    "folded": REORDERED,
    "placed": "SELECT version_id, goods_id, dept_id % 5 AS wh_dept_id, dt, sum(order_num) AS order_num FROM folded WHERE can_order = 1 GROUP BY ALL",
    "outflow": "SELECT version_id, goods_id, dt, sum(order_num) AS theory_order_sum FROM placed GROUP BY ALL",
    "bounds": "SELECT min(dt) AS first_day, max(dt) AS last_day FROM store_plan",
    "launched": """SELECT goods_id, min(launch) AS lo, CASE WHEN date_diff('day', min(launch), max(launch)) BETWEEN 1 AND 11 THEN max(launch) ELSE min(launch) END AS start_day FROM (
        SELECT goods_id, CAST(first_day + CAST(2 + dept_id % CASE goods_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 6 ELSE 20 END AS INTEGER) AS DATE) AS launch
        FROM (SELECT DISTINCT goods_id, dept_id FROM store_plan), bounds) GROUP BY 1""",
    "portions": "SELECT version_id, goods_id, " + ", ".join(
        f"{rounded(f'''avg(pred_consume) FILTER (WHERE (dayofyear(dt) - 1) // 7 + 1 = {k}) / (1.5e0 + 0.1e0 * goods_id)''', 2)} AS w{k}" for k in (1, 2, 3, 4)
    ) + " FROM store_plan GROUP BY 1, 2",
}


def lasting_sql(layers: Sequence[str], supply: str, facts: str = "") -> dict[str, str]:
    """SQL of the ends of all layers per version and goods, from ``supply`` per goods; the chain as ``ends``."""
    remains, earlier = [], "0e0"
    for layer in layers:
        remains.append(f"greatest(0, {layer} - greatest(0, dly_sum - ({earlier}))) AS {layer}_remain")
        earlier += f" + {layer}"
    per_layer = ", ".join(
        f"min(dt) FILTER (WHERE {c}_remain = 0) AS zero_{c}, arg_max({c}_remain, dt) AS {c}_left, max({c}) AS {c}" for c in layers
    )
    parts = {
        "supply": supply,
        "drawn": f"""SELECT *, {', '.join(remains)} FROM (SELECT o.*, s.* EXCLUDE (goods_id), sum(theory_order_sum) OVER (PARTITION BY o.version_id, o.goods_id ORDER BY dt) AS dly_sum
            FROM outflow o JOIN supply s ON o.goods_id = s.goods_id)""",
        "ends0": f"""SELECT version_id, goods_id, min(dt) AS dt_start, max(dt) AS dt_end, max(pur_use_ratio) AS pur_use_ratio{facts}, {per_layer},
            (SELECT avg(theory_order_sum) FROM (SELECT theory_order_sum FROM outflow q WHERE q.version_id = d.version_id AND q.goods_id = d.goods_id AND theory_order_sum > 0 ORDER BY dt DESC LIMIT 7)) AS last_seven
            FROM drawn d GROUP BY version_id, goods_id""",
    }
    before = None
    for k, layer in enumerate(layers):
        start = "dt_end" if before is None else f"greatest({before}_end, dt_end)"
        end = f"CASE WHEN zero_{layer} IS NOT NULL THEN greatest(zero_{layer}, {start}) ELSE CAST({start} + CAST(ceil({layer}_left / last_seven) AS INTEGER) AS DATE) END"
        if before is not None:
            end = f"CASE WHEN {layer} = 0 THEN greatest({end}, {before}_end) ELSE {end} END"
        name = "ends" if layer == layers[-1] else f"ends{k + 1}"
        parts[name], before = f"SELECT *, {end} AS {layer}_end FROM ends{k}", layer
    return parts


def layer_columns_sql(layers: Sequence[str], names: Sequence[tuple[str, str, str]]) -> str:
    columns, before = [], "dt_start"
    for layer, (quantity, days, deadline) in zip(layers, names, strict=True):
        columns.append(f"ceil({layer} / pur_use_ratio) AS {quantity}, CAST(date_diff('day', {before}, {layer}_end) AS INTEGER) AS {days}, strftime({layer}_end, '%Y-%m-%d') AS {deadline}")
        before = f"{layer}_end"
    return ", ".join(columns) + f", CAST(date_diff('day', dt_start, {before}) AS INTEGER) AS total_days"


BANDED = """SELECT goods_id, sum(po1) AS po1_amount, sum(po2) AS po2_amount, sum(po3 + round_even(supplier * ((po1 + po2 + po3) / total), 0) * 60) AS po3_amount,
    60e0 AS pur_use_ratio, max(lo) AS min_launch_date, CAST(max(first_day) + CAST(8 * (goods_id + 1) AS INTEGER) AS DATE) AS expire_day FROM (
  SELECT *, sum(po1 + po2 + po3) OVER (PARTITION BY goods_id) AS total, CAST(10 + goods_id AS DOUBLE) AS supplier FROM (
    SELECT goods_id, wh_dept_id, lo, sum(order_num) FILTER (WHERE dt <= e1) AS po1, coalesce(sum(order_num) FILTER (WHERE dt > e1 AND dt <= e1 + 5), 0) AS po2,
      coalesce(sum(order_num) FILTER (WHERE dt > e1 + 5 AND dt <= e1 + 12), 0) AS po3
    FROM (SELECT p.*, l.lo, CAST(l.start_day + CAST(3 + p.wh_dept_id % 2 AS INTEGER) AS DATE) AS e1 FROM placed p JOIN launched l ON p.goods_id = l.goods_id WHERE p.version_id = 1)
    GROUP BY 1, 2, 3) WHERE po1 IS NOT NULL), bounds GROUP BY goods_id"""


@query(
    "new_product_mart",
    sql("store_plan", f"""SELECT CAST(e.goods_id AS INTEGER) AS goods_id, {TAGS_SQL}, CAST(e.version_id AS INTEGER) AS consumer_version, {layer_columns_sql(pro.NEW_LAYERS, pro.NEW_NAMES)},
          w1, w2, w3, w4, CAST(date_diff('day', min_launch_date, (SELECT last_day FROM bounds)) + 1 AS INTEGER) AS plan_sale_duration,
          ceil((po1_amount_left + po2_amount_left + po3_amount_left) / pur_use_ratio) AS over_plan_quantity, CAST(expired <> 0 AS INTEGER) AS is_expire_risk, expired AS estimated_expired_quantity
        FROM (SELECT *, ceil(CASE WHEN expire_day <= dt_end THEN po1_amount + po2_amount + po3_amount - consumed
                WHEN expire_day < po3_amount_end THEN po1_amount + po2_amount + po3_amount - consumed - date_diff('day', expire_day, po3_amount_end) * last_seven ELSE 0 END / pur_use_ratio) AS expired FROM ends) e
        JOIN portions p ON e.version_id = p.version_id AND e.goods_id = p.goods_id""",
        recursive=True, **LAUNCHED,
        **lasting_sql(pro.NEW_LAYERS, BANDED, ", max(expire_day) AS expire_day, max(min_launch_date) AS min_launch_date, coalesce(sum(theory_order_sum) FILTER (WHERE dt < expire_day), 0) AS consumed")),
)
def new_product_mart(inp: Inputs) -> DataFrame:
    """Launch type, first deliveries, their ends and expiry of every goods under both consumer versions."""
    run = Launched(inp)
    supply = pro.first_supply(run.stocked, run.launches, run.terms, run.goods.select("goods_id", "supplier_stock"))
    supply = staged(supply.join(run.goods.select("goods_id", "expire_day"), "goods_id"), "supply")
    return sinks.apply_contract(pro.new_product_mart(run.outflow, supply, run.portions, run.last, TAGS), sinks.NEW_PRODUCT)


RECENT = """SELECT goods_id, sum(beg) AS beg_wh_stock, sum(cg) AS cg_zt, sum(po) AS po_zt, sum(ceil(greatest(0, need - po - cg - beg) / 60) * 60) AS pp_zt, 60e0 AS pur_use_ratio FROM (
    SELECT *, round_even(200e0 * (1 + goods_id) * (need / sum(need) OVER (PARTITION BY goods_id)), 0) AS po,
      CASE WHEN wh_dept_id % 2 = 0 THEN 90e0 * (1 + goods_id % 2) ELSE 0 END AS beg, CASE WHEN wh_dept_id % 2 = 1 THEN 150e0 ELSE 0 END AS cg FROM (
      SELECT goods_id, wh_dept_id, sum(order_num) AS need FROM placed, bounds WHERE version_id = 1 AND dt > first_day + 5
        AND dt <= first_day + 5 + CAST(2 + 1 + wh_dept_id % 3 + 4 AS INTEGER) GROUP BY 1, 2)) GROUP BY goods_id"""


@query(
    "recent_product_mart",
    sql("store_plan", f"""SELECT CAST(e.goods_id AS INTEGER) AS goods_id, {TAGS_SQL}, CAST(e.version_id AS INTEGER) AS consumer_version, {layer_columns_sql(pro.RECENT_LAYERS, pro.RECENT_NAMES)}, w1, w2, w3, w4
        FROM ends e JOIN portions p ON e.version_id = p.version_id AND e.goods_id = p.goods_id""",
        recursive=True, **LAUNCHED, **lasting_sql(pro.RECENT_LAYERS, RECENT)),
)
def recent_product_mart(inp: Inputs) -> DataFrame:
    """Stock, transit, open purchases and replenishment of every goods under both consumer versions, from the sixth plan day."""
    run = Launched(inp)
    run_day = F.date_add(run.first, 5)
    supply = pro.recent_supply(run.stocked, run.terms, run.stock, run.arriving, run.goods.select("goods_id", "po_total"), run_day)
    mart = pro.recent_product_mart(run.outflow, staged(supply, "supply"), run.portions, run_day, TAGS)
    return sinks.apply_contract(mart, sinks.RECENT_PRODUCT)


@query(
    "launch_bands",
    sql("store_plan", """SELECT goods_id, wh_dept_id, CAST(CASE WHEN hi = lo THEN 1 WHEN date_diff('day', lo, hi) <= 11 THEN 2 ELSE 3 END AS BIGINT) AS new_type,
          po1 AS po1_amount, po2 AS po2_amount, po3 + round_even((10e0 + goods_id) * ((po1 + po2 + po3) / sum(po1 + po2 + po3) OVER (PARTITION BY goods_id)), 0) * 60 AS po3_amount FROM (
        SELECT goods_id, wh_dept_id, lo, hi, sum(order_num) FILTER (WHERE dt <= e1) AS po1, coalesce(sum(order_num) FILTER (WHERE dt > e1 AND dt <= e1 + 5), 0) AS po2,
          coalesce(sum(order_num) FILTER (WHERE dt > e1 + 5 AND dt <= e1 + 12), 0) AS po3
        FROM (SELECT p.*, l.lo, h.hi, CAST(l.start_day + CAST(3 + p.wh_dept_id % 2 AS INTEGER) AS DATE) AS e1 FROM placed p JOIN launched l ON p.goods_id = l.goods_id
          JOIN (SELECT goods_id, max(first_day + CAST(2 + dept_id % CASE goods_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 6 ELSE 20 END AS INTEGER)) AS hi FROM store_plan, bounds GROUP BY 1) h
          ON p.goods_id = h.goods_id WHERE p.version_id = 1) GROUP BY 1, 2, 3, 4) WHERE po1 IS NOT NULL""", recursive=True, **LAUNCHED),
)
def launch_bands(inp: Inputs) -> DataFrame:
    """The three bands per goods and warehouse, from the start that the launch type sets, with the supplier's stock."""
    run = Launched(inp)
    supply = pro.first_supply(run.stocked, run.launches, run.terms, run.goods.select("goods_id", "supplier_stock"))
    return supply.select("goods_id", "wh_dept_id", "new_type", *pro.NEW_LAYERS)
