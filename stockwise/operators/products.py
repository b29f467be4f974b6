"""Supply marts of new and recently launched products: orders, supply layers, how long they last, what expires.

All goods and consumer versions go through one plan: what differs between them (launch days, lead times, stocks) are columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stockwise.functions.numeric import ceil_units, half_even
from stockwise.operators import replenish as rep
from stockwise.operators.aggregate import pivot_labels
from stockwise.operators.windows import running_total
from stockwise.session import staged

NEW_LAYERS = ["po1_amount", "po2_amount", "po3_amount"]
RECENT_LAYERS = ["beg_wh_stock", "cg_zt", "po_zt", "pp_zt"]
WEEKS = ["w1", "w2", "w3", "w4"]


def launch_start(kind: str = "new_type") -> Column:
    """The day from which supply is counted: the last launch where launches follow each other within days, else the first."""
    return F.when(F.col(kind) == 2, F.col("max_launch_date")).otherwise(F.col("min_launch_date"))


def first_supply(orders: DataFrame, launches: DataFrame, terms: DataFrame, supplier: DataFrame, cold_start_days: int = 11) -> DataFrame:
    """Per goods and warehouse what the stock-up version orders in its three bands, the supplier's stock shared out on top.

    orders: ``goods_id, wh_dept_id, dt, order_num`` of the stock-up version; launches: ``goods_id, launch`` per store; terms: ``goods_id,
    wh_dept_id, wh_bp, wh_lt, pt, mt, pur_use_ratio``; supplier: ``goods_id, supplier_stock`` in purchase units.  The bands follow each other
    from the start of the launch type; warehouses without an order in the first band are left out.
    """
    facts = rep.launch_type(launches, ["goods_id"], "launch", cold_start_days)
    rows = orders.join(terms, ["goods_id", "wh_dept_id"]).join(facts, "goods_id").join(supplier, "goods_id", "left")
    rows = rows.na.fill(0.0, ["supplier_stock"])
    keys = ["goods_id", "wh_dept_id", "pur_use_ratio", "supplier_stock", "new_type", "min_launch_date"]
    bands = rep.stockup_bands(rows, keys, "dt", launch_start(), "order_num")
    need = F.col("po1_amount") + F.col("po2_amount") + F.col("po3_amount")
    shared = rep.proportional_allocation(bands, ["goods_id"], need, F.col("supplier_stock"), "units")
    extra = F.coalesce(F.col("units"), F.lit(0.0)) * F.col("pur_use_ratio")
    return shared.withColumn("po3_amount", F.col("po3_amount") + extra).drop("units", "dis_ratio", "supplier_stock")


def recent_supply(orders: DataFrame, terms: DataFrame, stock: DataFrame, arriving: DataFrame, ordered: DataFrame, run_day: Column) -> DataFrame:
    """Per goods and warehouse the stock, what is on its way, the share of open purchases, and what is still to be ordered.

    orders: as in :func:`first_supply`; terms: ``goods_id, wh_dept_id, vlt_po, second_bp_po, ss_po, pur_use_ratio``; stock: ``..., beg_wh_stock``;
    arriving: ``..., cg_zt``; ordered: ``goods_id, po_total``.  The need is what is ordered after the run day, up to the end of
    lead time, cover period and safety stock; open purchases are shared out by need.
    """
    keys = ["goods_id", "wh_dept_id"]
    until = F.date_add(run_day, (F.col("vlt_po") + F.col("second_bp_po") + F.col("ss_po")).cast("int"))
    ahead = orders.join(terms, keys).where((F.col("dt") > run_day) & (F.col("dt") <= until))
    need = ahead.groupBy(*keys, "pur_use_ratio").agg(F.sum("order_num").alias("_need_own"))
    need = need.join(ordered, "goods_id", "left").na.fill(0.0, ["po_total"])
    shared = rep.proportional_allocation(need, ["goods_id"], F.col("_need_own"), F.col("po_total"), "po_zt").na.fill(0.0, ["po_zt"])
    full = shared.join(stock, keys, "left").join(arriving, keys, "left").na.fill(0.0, ["beg_wh_stock", "cg_zt"])
    gap = rep.replenish_gap(F.col("_need_own"), [F.col("po_zt"), F.col("cg_zt"), F.col("beg_wh_stock")], F.col("pur_use_ratio"))
    return full.withColumn("pp_zt", gap).select(*keys, "pur_use_ratio", *RECENT_LAYERS)


def lasting(outflow: DataFrame, supply: DataFrame, layers: Sequence[str], facts: Sequence[str] = ()) -> DataFrame:
    """Per goods and consumer version the end of every supply layer when the summed outflow eats them in order.

    outflow: ``version_id, goods_id, dt, theory_order_sum``; supply: layers per goods and warehouse, ``pur_use_ratio`` and per-goods
    ``facts``; an ``expire_day`` among them gives what is consumed before it.
    """
    nation = supply.groupBy("goods_id").agg(
        *(F.sum(c).alias(c) for c in layers), F.max("pur_use_ratio").alias("pur_use_ratio"), *(F.max(c).alias(c) for c in facts)
    )
    keys = ["version_id", "goods_id"]
    days = running_total(outflow, keys, "dt", "theory_order_sum", "dly_sum").join(nation, "goods_id")
    days = staged(rep.layered_drawdown(days, layers, "dly_sum"), "drawn")
    ends = rep.depletion_dates(days, keys, "dt", layers, "theory_order_sum")
    known = [F.max(c).alias(c) for c in ("pur_use_ratio", *facts)]
    if "expire_day" in facts:
        before = F.sum(F.when(F.col("dt") < F.col("expire_day"), F.col("theory_order_sum")))
        known.append(F.coalesce(before, F.lit(0.0)).alias("consumed"))
    return ends.join(days.groupBy(*keys).agg(*known), keys)


def weekly_portions(consumption: DataFrame, needs: DataFrame) -> DataFrame:
    """Mean consumption of the first four weeks in portions: ``version_id, goods_id, w1 ... w4``.

    consumption: ``version_id, goods_id, week, pred_consume`` with weeks named like the columns; needs: ``goods_id, avg_needs``.
    """
    mean = pivot_labels(consumption, ["version_id", "goods_id"], "week", WEEKS, F.avg("pred_consume"))
    return mean.join(needs, "goods_id").select(
        "version_id", "goods_id", *(half_even(F.try_divide(F.col(w), F.col("avg_needs")), 2).alias(w) for w in WEEKS)
    )


def deadlines(ends: DataFrame, layers: Sequence[str], names: Sequence[tuple[str, str, str]], fallback: Column | None = None) -> DataFrame:
    """Quantity in purchase units, days and end day per layer under the given (quantity, days, deadline) names, and ``total_days``.

    fallback: the end of layers that nothing consumes; their days are then 0.
    """
    columns, previous = {}, F.col("dt_start")
    for layer, (quantity, days, deadline) in zip(layers, names, strict=True):
        end = F.col(f"{layer}_end")
        columns[quantity] = ceil_units(F.col(layer), F.col("pur_use_ratio"))
        columns[days] = F.date_diff(end, previous)
        columns[deadline] = end if fallback is None else F.coalesce(end, fallback)
        previous = end
    columns["total_days"] = F.date_diff(previous, F.col("dt_start"))
    if fallback is not None:
        columns |= {c: F.coalesce(columns[c], F.lit(0)) for c in ("total_days", *(n[1] for n in names))}
    return ends.withColumns(columns)


def tagged(mart: DataFrame, tags: Mapping[str, int]) -> DataFrame:
    """The labels of a run; the version that consumes is a column of the rows."""
    return mart.withColumn("consumer_version", F.col("version_id")).withColumns({name: F.lit(value) for name, value in tags.items()})


NEW_NAMES = [
    ("first_delivery_quantity", "first_delivery_days", "first_deadline"),
    ("goods_stock_up_quantity", "goods_stock_up_days", "goods_deadline"),
    ("raw_stock_quantity", "raw_stock_days", "raw_deadline"),
]
RECENT_NAMES = [
    ("stock_quantity", "stock_days", "stock_deadline"),
    ("cg_trs_quantity", "cg_trs_days", "cg_trs_deadline"),
    ("po_quantity", "po_days", "po_deadline"),
    ("replenish_quantity", "replenish_days", "replenish_deadline"),
]


def new_product_mart(outflow: DataFrame, supply: DataFrame, portions: DataFrame, plan_end: Column, tags: Mapping[str, int]) -> DataFrame:
    """One row per goods and consumer version: bands, their ends, the plan's left-over and what expires.

    supply: as from :func:`first_supply`, with ``expire_day``.  Quantities are in purchase units.
    """
    ends = lasting(outflow, supply, NEW_LAYERS, ["expire_day", "min_launch_date"])
    risk = rep.expiry_risk(ends, F.col("consumed"), NEW_LAYERS, "po3_amount")
    mart = deadlines(risk, NEW_LAYERS, NEW_NAMES).withColumn("plan_sale_duration", F.date_diff(plan_end, F.col("min_launch_date")) + 1)
    return tagged(mart.join(portions, ["version_id", "goods_id"], "left"), tags)


def recent_product_mart(outflow: DataFrame, supply: DataFrame, portions: DataFrame, run_day: Column, tags: Mapping[str, int]) -> DataFrame:
    """One row per goods and consumer version: stock, transit, purchases and replenishment, and how long each lasts.

    Without any consumption a layer lasts 0 days and ends a year after the run day.
    """
    ends = lasting(outflow, supply, RECENT_LAYERS)
    mart = deadlines(ends, RECENT_LAYERS, RECENT_NAMES, F.date_add(run_day, 365))
    return tagged(mart.join(portions, ["version_id", "goods_id"], "left"), tags)
