"""Queries: projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockwise.functions import dates
from stockwise.functions import numeric as num
from stockwise.operators import series
from stockwise.operators.windows import previous_value
from stockwise.plans.inputs import KEYS, Inputs, rounded, sql
from stockwise.plans.registry import query
from stockwise.sources import sinks


@query("project_rename", "SELECT l_suppkey AS wh_dept_id, l_partkey AS goods_id, l_quantity AS demand, CAST(l_shipdate AS DATE) AS predict_dt FROM lineitem")
def project_rename(inp: Inputs) -> DataFrame:
    return (
        inp.table("lineitem")
        .drop("l_comment", "l_tax")
        .withColumnsRenamed({"l_suppkey": "wh_dept_id", "l_partkey": "goods_id", "l_quantity": "demand"})
        .select("wh_dept_id", "goods_id", "demand", F.to_date("l_shipdate").alias("predict_dt"))
    )


@query(
    "population_filter",
    sql("sold_rows", """SELECT 'all' AS data_label, wh_dept_id, goods_id, sum(qty) AS qty, count(*) AS n FROM sold_rows GROUP BY 2, 3
      UNION ALL SELECT 'normal', wh_dept_id, goods_id, sum(qty), count(*) FROM sold_rows WHERE type_flg = 'norm' AND shop_type_flg = 'norm_shop' GROUP BY 2, 3
      UNION ALL SELECT 'new_shop_normal', wh_dept_id, goods_id, sum(qty), count(*) FROM sold_rows WHERE type_flg = 'norm' AND shop_type_flg = 'new_shop' GROUP BY 2, 3"""),
)
def population_filter(inp: Inputs) -> DataFrame:
    labelled = series.with_populations(inp.sold_rows)
    return labelled.groupBy("data_label", *KEYS).agg(F.sum("qty").alias("qty"), F.count("*").alias("n"))


@query("filter_in_notin", "SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('F')")
def filter_in_notin(inp: Inputs) -> DataFrame:
    wanted = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderstatus").isin("F")
    return inp.table("orders").where(wanted).select("o_orderkey", "o_orderpriority", "o_orderstatus")


@query(
    "filter_date_range",
    """SELECT o_orderkey, 'closed' AS kind FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-01-31'
       UNION ALL SELECT o_orderkey, 'half_open' FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1997-01-31'""",
)
def filter_date_range(inp: Inputs) -> DataFrame:
    orders = inp.table("orders").select("o_orderkey", "o_orderdate")
    start, end = F.lit("1997-01-01").cast("timestamp"), F.lit("1997-01-31").cast("timestamp")
    day = F.col("o_orderdate")
    closed = orders.where(day.between(start, end)).withColumn("kind", F.lit("closed"))
    half_open = orders.where((day >= start) & (day < end)).withColumn("kind", F.lit("half_open"))
    return closed.unionByName(half_open).select("o_orderkey", "kind")


@query(
    "filter_nulls",
    """SELECT c_custkey, o_orderkey IS NULL AS no_order FROM customer LEFT JOIN
       (SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON c_custkey = o_custkey""",
)
def filter_nulls(inp: Inputs) -> DataFrame:
    orders = inp.table("orders").where(F.col("o_orderstatus") == "P")
    last = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderkey").alias("o_orderkey"))
    joined = inp.table("customer").select("c_custkey").join(last, "c_custkey", "left")
    missing = joined.where(F.col("o_orderkey").isNull()).select("c_custkey", F.lit(True).alias("no_order"))
    present = joined.where(F.col("o_orderkey").isNotNull()).select("c_custkey", F.lit(False).alias("no_order"))
    return missing.unionByName(present)


@query(
    "cast_contract",
    """SELECT CAST(o_orderkey AS INTEGER) AS goods_id, CAST(trunc(o_totalprice) AS BIGINT) AS whole, CAST(o_orderkey AS VARCHAR) AS key_text,
         TRY_CAST(o_orderpriority AS INTEGER) AS not_a_number, TRY_CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority FROM orders""",
)
def cast_contract(inp: Inputs) -> DataFrame:
    return inp.table("orders").select(
        F.col("o_orderkey").cast("int").alias("goods_id"),
        F.col("o_totalprice").cast("long").alias("whole"),
        F.col("o_orderkey").cast("string").alias("key_text"),
        F.col("o_orderpriority").try_cast("int").alias("not_a_number"),
        F.col("o_orderpriority").substr(1, 1).try_cast("double").alias("priority"),
    )


@query(
    "scalar_math",
    f"""SELECT l_orderkey, l_linenumber, abs(l_quantity - 25) AS dist, pow(l_quantity - 25, 2) AS sq, {rounded('sqrt(l_quantity)', 6)} AS root,
         ceil(l_extendedprice / 100) AS up, floor(l_extendedprice / 100) AS down, {rounded('l_extendedprice / 8', 2)} AS even,
         {rounded('l_quantity / 2')} AS half FROM lineitem""",
)
def scalar_math(inp: Inputs) -> DataFrame:
    qty, money = F.col("l_quantity"), F.col("l_extendedprice")
    return inp.table("lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.abs(qty - 25).alias("dist"),
        F.pow(qty - 25, F.lit(2.0)).alias("sq"),
        num.half_even(F.sqrt(qty), 6).alias("root"),
        F.ceil(money / 100).cast("double").alias("up"),
        F.floor(money / 100).cast("double").alias("down"),
        num.half_even(money / 8, 2).alias("even"),
        num.half_even(qty / 2).alias("half"),
    )


@query(
    "clip_bounds",
    """SELECT c_custkey, CASE WHEN c_acctbal - 3000 < 0 THEN 0e0 ELSE c_acctbal - 3000 END AS floored,
         CASE WHEN b < 2 THEN 2e0 WHEN b > 100 THEN 100e0 ELSE b END AS bounded
       FROM (SELECT *, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_acctbal / 50 END AS b FROM customer)""",
)
def clip_bounds(inp: Inputs) -> DataFrame:
    scaled = F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_acctbal") / 50)
    return inp.table("customer").select(
        "c_custkey", num.at_least(F.col("c_acctbal") - 3000).alias("floored"), num.clamp(scaled, 2.0, 100.0).alias("bounded")
    )


@query(
    "null_defaults",
    """SELECT c_custkey, coalesce(a, b, -1e0) AS price, coalesce(b, 0e0) AS b_filled, coalesce(seg, 'none') AS seg FROM (
         SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS a, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal / 2 END AS b,
           CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_mktsegment END AS seg FROM customer)""",
)
def null_defaults(inp: Inputs) -> DataFrame:
    key, balance, segment = F.col("c_custkey"), F.col("c_acctbal"), F.col("c_mktsegment")
    gaps = inp.table("customer").select(
        "c_custkey",
        F.when(key % 3 == 0, balance).alias("a"),
        F.when(key % 2 == 0, balance / 2).alias("b"),
        F.when(segment != "FURNITURE", segment).alias("seg"),
    )
    chain = gaps.withColumn("price", F.coalesce("a", "b", F.lit(-1.0)))
    return chain.na.fill({"b": 0.0, "seg": "none"}).select("c_custkey", "price", F.col("b").alias("b_filled"), "seg")


@query(
    "safe_ratio",
    sql("wh_demand", f"""SELECT wh_dept_id, goods_id, ds, {rounded('CASE WHEN prev <> 0 THEN y / prev ELSE 0 END', 6)} AS growth FROM (
      SELECT *, lag(y) OVER (PARTITION BY wh_dept_id, goods_id ORDER BY ds) AS prev FROM wh_demand)"""),
)
def safe_ratio(inp: Inputs) -> DataFrame:
    stepped = previous_value(inp.wh_demand, KEYS, "ds", "y", "prev")
    growth = num.half_even(num.safe_ratio(F.col("y"), F.col("prev")), 6)
    return stepped.select(*KEYS, "ds", growth.alias("growth"))


@query(
    "case_when",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_totalprice > 300000 THEN 'large' ELSE 'open' END AS state,
         CASE WHEN o_totalprice > 0 AND o_orderstatus = 'P' THEN 0e0 ELSE o_totalprice END AS masked FROM orders""",
)
def case_when(inp: Inputs) -> DataFrame:
    status, price = F.col("o_orderstatus"), F.col("o_totalprice")
    return inp.table("orders").select(
        "o_orderkey",
        F.when(status == "F", "done").when(price > 300000, "large").otherwise("open").alias("state"),
        F.when((price > 0) & (status == "P"), 0.0).otherwise(price).alias("masked"),
    )


BAND_CASE = """CASE WHEN err <= 0.2 THEN 'pe20' WHEN err <= 0.4 THEN 'pe40' WHEN err <= 0.6 THEN 'pe60'
  WHEN err <= 0.8 THEN 'pe80' WHEN err <= 1 THEN 'pe100' WHEN err > 1 THEN 'pe_more' END"""
BAND_FLAGS = ", ".join(f"CAST(band = '{b}' AS BIGINT) AS {b}" for b in num.BAND_LABELS)


@query(
    "error_bands",
    sql("evaluated", f"""SELECT model, dt, predict_dt, wh_dept_id, goods_id, band, {BAND_FLAGS} FROM (
      SELECT *, {BAND_CASE} AS band FROM (SELECT *, abs(predict_demand - y) / y AS err FROM evaluated))"""),
)
def error_bands(inp: Inputs) -> DataFrame:
    err = F.abs(F.col("predict_demand") - F.col("y")) / F.col("y")
    banded = inp.evaluated.withColumn("band", num.band_label(err)).withColumns(num.band_flags(err))
    return banded.select("model", "dt", "predict_dt", *KEYS, "band", *num.BAND_LABELS)


@query(
    "box_round",
    f"""SELECT l_orderkey, l_linenumber, {rounded('CASE WHEN l_quantity > 0 AND l_quantity < 12 THEN 12e0 ELSE l_quantity END / 12')} * 12 AS boxed FROM lineitem""",
)
def box_round(inp: Inputs) -> DataFrame:
    boxed = num.box_round(F.col("l_quantity"), F.lit(12.0))
    return inp.table("lineitem").select("l_orderkey", "l_linenumber", boxed.alias("boxed"))


@query("ceil_to_multiple", "SELECT l_orderkey, l_linenumber, ceil(l_quantity / 12) * 12 AS pieces, ceil(l_quantity / 12) AS units FROM lineitem")
def ceil_to_multiple(inp: Inputs) -> DataFrame:
    qty, unit = F.col("l_quantity"), F.lit(12.0)
    return inp.table("lineitem").select(
        "l_orderkey", "l_linenumber", num.ceil_to_multiple(qty, unit).alias("pieces"), num.ceil_units(qty, unit).alias("units")
    )


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(day(o_orderdate) AS INTEGER) AS day,
         CAST(isodow(o_orderdate) - 1 AS INTEGER) AS day_of_week, CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year FROM orders""",
)
def date_parts(inp: Inputs) -> DataFrame:
    parts = dates.date_parts(F.to_date("o_orderdate"))
    return inp.table("orders").select("o_orderkey", *(c.alias(n) for n, c in parts.items()))


@query(
    "date_arith",
    """SELECT l_orderkey, l_linenumber, CAST(l_shipdate + INTERVAL 21 DAY AS DATE) AS arrive, CAST(l_shipdate - INTERVAL 180 DAY AS DATE) AS back,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS lead, strftime(l_shipdate, '%Y-%m-%d') AS text
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def date_arith(inp: Inputs) -> DataFrame:
    line, orders = inp.table("lineitem"), inp.table("orders")
    ship = F.to_date("l_shipdate")
    return line.join(orders, line.l_orderkey == orders.o_orderkey).select(
        "l_orderkey",
        "l_linenumber",
        F.date_add(ship, 21).alias("arrive"),
        F.date_sub(ship, 180).alias("back"),
        F.date_diff(ship, F.to_date("o_orderdate")).alias("lead"),
        F.date_format(ship, "yyyy-MM-dd").alias("text"),
    )


@query(
    "calendar_gen",
    """WITH span AS (SELECT o_orderpriority, min(o_orderdate)::DATE AS a, max(o_orderdate)::DATE AS b FROM orders GROUP BY 1)
       SELECT o_orderpriority, kind, day FROM (
         SELECT o_orderpriority, 'day' AS kind, unnest(generate_series(a, b, INTERVAL 1 DAY))::DATE AS day FROM span
         UNION ALL SELECT o_orderpriority, 'month_end', last_day(unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH))::DATE) FROM span
         UNION ALL SELECT o_orderpriority, 'previous_month', (date_trunc('month', b) - to_months(unnest([1, 2, 3])))::DATE FROM span)""",
)
def calendar_gen(inp: Inputs) -> DataFrame:
    span = inp.table("orders").groupBy("o_orderpriority").agg(
        F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("b")
    )
    a, b = F.col("a"), F.col("b")
    kinds = {"day": F.sequence(a, b), "month_end": series.month_ends(a, b), "previous_month": series.previous_month_starts(b, 3)}
    listed = F.create_map(*(x for kind, days in kinds.items() for x in (F.lit(kind), days)))
    exploded = span.select("o_orderpriority", F.explode(listed).alias("kind", "days"))
    return exploded.select("o_orderpriority", "kind", F.explode("days").alias("day"))


@query(
    "plan_contracts",
    sql("store_plan", f"""SELECT strftime(dt, '%Y-%m-%d') AS predict_dt, CAST(goods_id AS INTEGER) AS goods_id, CAST(1 AS INTEGER) AS material_type,
      CAST(2 AS INTEGER) AS scene, CAST(1 AS INTEGER) AS stock_up_version, CAST(version_id AS INTEGER) AS consumer_version,
      CAST(7 AS INTEGER) AS strategy_version_id, CAST(3 AS INTEGER) AS sim_version, {rounded('avg(1e0 - closed)', 5)} AS shop_avl_rate,
      CAST(sum(can_order) AS INTEGER) AS wh_avl_days, CAST(max(can_order) AS INTEGER) AS shop_avl_days, 5e0 AS dly_use_ratio, 60e0 AS pur_use_ratio,
      CAST(0 AS INTEGER) AS is_min_launch_day, sum(pred_consume) AS shop_consume_amount, sum(bp_consume) AS wh_consume_amount
      FROM store_plan GROUP BY dt, goods_id, version_id"""),
)
def plan_contracts(inp: Inputs) -> DataFrame:
    mart = inp.store_plan.groupBy("dt", "goods_id", "version_id").agg(
        num.half_even(F.avg(1.0 - F.col("closed")), 5).alias("shop_avl_rate"),
        F.sum("can_order").alias("wh_avl_days"),
        F.max("can_order").alias("shop_avl_days"),
        F.sum("pred_consume").alias("shop_consume_amount"),
        F.sum("bp_consume").alias("wh_consume_amount"),
    )
    tags = {"material_type": 1, "scene": 2, "stock_up_version": 1, "strategy_version_id": 7, "sim_version": 3, "is_min_launch_day": 0}
    labelled = (
        mart.withColumnsRenamed({"dt": "predict_dt", "version_id": "consumer_version"})
        .withColumns({name: F.lit(value) for name, value in tags.items()})
        .withColumns({"dly_use_ratio": F.lit(5), "pur_use_ratio": F.lit(60)})
    )
    return sinks.apply_contract(labelled, sinks.AVAILABILITY)
