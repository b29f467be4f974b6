"""Queries: replenishment and stock planning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockwise.functions.numeric import half_even
from stockwise.operators import aggregate as agg
from stockwise.operators import replenish as rep
from stockwise.operators import series
from stockwise.operators import windows as win
from stockwise.operators.joins import outer_filled
from stockwise.plans.inputs import KEYS, Inputs, rounded, sql
from stockwise.plans.registry import query
from stockwise.session import staged
from stockwise.sources import sinks

PLAN = ["version_id", "dept_id", "goods_id"]
PLAN_SQL = "version_id, dept_id, goods_id"


def rolled(plan: DataFrame) -> DataFrame:
    return rep.stock_rollforward(plan, PLAN, "dt", "shop_beg", "expected_receive", "pred_consume")


NUMBERED = f"SELECT *, row_number() OVER (PARTITION BY {PLAN_SQL} ORDER BY dt) AS rn FROM store_plan"


@query(
    "stock_rollforward",
    sql("store_plan", f"SELECT {PLAN_SQL}, dt, stock_beg, stock_end FROM walked WHERE rn > 0", recursive=True, numbered=NUMBERED,
        walked=f"""SELECT {PLAN_SQL}, NULL::DATE AS dt, 0::BIGINT AS rn, 0e0 AS stock_beg, shop_beg AS stock_end FROM numbered WHERE rn = 1
          UNION ALL SELECT n.version_id, n.dept_id, n.goods_id, n.dt, n.rn, w.stock_end, greatest(0, w.stock_end + n.expected_receive - n.pred_consume)
          FROM walked w JOIN numbered n ON w.version_id = n.version_id AND w.dept_id = n.dept_id AND w.goods_id = n.goods_id AND n.rn = w.rn + 1"""),
)
def stock_rollforward(inp: Inputs) -> DataFrame:
    return rolled(inp.store_plan).select(*PLAN, "dt", "stock_beg", "stock_end")


ROLLED = f"""SELECT *, coalesce(lag(stock_end) OVER k, shop_beg) AS stock_beg FROM (
  SELECT *, free - least(0, min(free) OVER k) AS stock_end FROM (
    SELECT *, shop_beg + sum(expected_receive - pred_consume) OVER k AS free FROM store_plan WINDOW k AS (PARTITION BY {PLAN_SQL} ORDER BY dt))
  WINDOW k AS (PARTITION BY {PLAN_SQL} ORDER BY dt)) WINDOW k AS (PARTITION BY {PLAN_SQL} ORDER BY dt)"""
PACKED = rounded("CASE WHEN order_calc > 0 AND order_calc < dly_use_ratio THEN dly_use_ratio ELSE order_calc END / dly_use_ratio") + " * dly_use_ratio"


@query(
    "order_quantity",
    sql("store_plan", f"""SELECT {PLAN_SQL}, dt, pred_vlt_end, order_calc, {PACKED} AS order_num FROM (
      SELECT *, greatest(0, greatest(0, bp_consume + ss_ro) - pred_vlt_end) AS order_calc FROM (
        SELECT *, greatest(0, stock_beg + expected_receive + dly_num - vlt_consume) AS pred_vlt_end FROM (
          SELECT *, coalesce(sum(expected_receive) OVER (PARTITION BY {PLAN_SQL} ORDER BY dt ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS dly_num FROM rolled)))
      WHERE can_order = 1""", rolled=ROLLED),
)
def order_quantity(inp: Inputs) -> DataFrame:
    days = rep.later_sum(rolled(inp.store_plan), PLAN, "dt", "expected_receive", "dly_num")
    stock = F.col("stock_beg") + F.col("expected_receive") + F.col("dly_num")
    columns = rep.order_quantity(stock, F.col("bp_consume") + F.col("ss_ro"), F.col("vlt_consume"), F.col("dly_use_ratio"))
    return days.where(F.col("can_order") == 1).select(*PLAN, "dt", *(c.alias(n) for n, c in columns.items()))


@query(
    "shortage_allocation",
    sql("store_orders", """SELECT wh_dept_id, goods_id, dt, dept_id, order_num, resign FROM (
        SELECT o.wh_dept_id, o.goods_id, o.dt, o.dept_id, o.order_num, coalesce(sum(b.amount) FILTER (WHERE b.before < o.wh_begin), 0) AS resign
        FROM store_orders o JOIN boxes b ON o.wh_dept_id = b.wh_dept_id AND o.goods_id = b.goods_id AND o.dt = b.dt AND o.dept_id = b.dept_id
        WHERE o.wh_begin < o.wh_order_sum GROUP BY 1, 2, 3, 4, 5)
      UNION ALL SELECT wh_dept_id, goods_id, dt, dept_id, order_num, order_num FROM store_orders WHERE wh_begin >= wh_order_sum""",
        single="""SELECT wh_dept_id, goods_id, dt, dept_id, order_num, unnest(range(1, CAST(ceil(order_num / 10) AS BIGINT) + 1)) AS round FROM store_orders""",
        boxes="""SELECT *, coalesce(sum(amount) OVER (PARTITION BY wh_dept_id, goods_id, dt ORDER BY round, order_num DESC, dept_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT *, least(10, order_num - (round - 1) * 10) AS amount FROM single)"""),
)
def shortage_allocation(inp: Inputs) -> DataFrame:
    group = ["wh_dept_id", "goods_id", "dt"]
    granted = rep.shortage_allocation(inp.store_orders, group, "dept_id", "order_num", "wh_begin", "dly_use_ratio")
    return granted.select(*group, "dept_id", "order_num", "resign")


@query(
    "warehouse_balance",
    sql("store_orders", """SELECT wh_dept_id, goods_id, dt, beg_wh_stock, transit, wh_order_sum, beg_wh_stock + transit AS wh_begin,
        greatest(0, beg_wh_stock + transit - wh_order_sum) AS wh_end, greatest(0, wh_order_sum - beg_wh_stock - transit) AS wh_short FROM (
      SELECT wh_dept_id, goods_id, dt, max(wh_begin) AS beg_wh_stock, CASE WHEN month(dt) % 2 = 0 THEN CAST(150 AS DOUBLE) ELSE 0e0 END AS transit,
        sum(order_num) AS wh_order_sum FROM store_orders GROUP BY 1, 2, 3)"""),
)
def warehouse_balance(inp: Inputs) -> DataFrame:
    keys = ["wh_dept_id", "goods_id", "dt"]
    orders = staged(inp.store_orders, "store-orders")
    stock = orders.groupBy(*keys).agg(F.max("wh_begin").alias("beg_wh_stock"))
    even = F.month("dt") % 2 == 0
    arrivals = stock.select(*keys, F.explode(F.array(F.when(even, 100.0).otherwise(0.0), F.when(even, 50.0).otherwise(0.0))).alias("transit"))
    return rep.warehouse_balance(stock, arrivals, orders, keys)


REORDERED = f"""SELECT {PLAN_SQL}, NULL::DATE AS dt, NULL::DATE AS receive_day, 0::BIGINT AS can_order, 0::BIGINT AS rn, max(shop_beg) AS stock,
    coalesce(list({{'rd': dt, 'q': expected_receive}}) FILTER (WHERE expected_receive > 0), []) AS ledger, 0e0 AS order_calc, 0e0 AS order_num
  FROM numbered GROUP BY 1, 2, 3
  UNION ALL
  SELECT {PLAN_SQL}, dt, receive_day, can_order, rn, greatest(0, stock + rec - pred_consume),
    CASE WHEN can_order = 1 THEN list_append(ledger, {{'rd': receive_day, 'q': order_num}}) ELSE ledger END, order_calc, order_num FROM (
    SELECT *, {PACKED} AS order_num FROM (
      SELECT *, greatest(0, greatest(0, bp_consume + ss_ro) - greatest(0, stock + rec + pend - vlt_consume)) AS order_calc FROM (
        SELECT n.*, f.stock, f.ledger,
          coalesce(list_sum(list_transform(list_filter(f.ledger, lambda e: e.rd = n.dt), lambda e: e.q)), 0) AS rec,
          coalesce(list_sum(list_transform(list_filter(f.ledger, lambda e: e.rd > n.dt), lambda e: e.q)), 0) AS pend
        FROM folded f JOIN numbered n ON f.version_id = n.version_id AND f.dept_id = n.dept_id AND f.goods_id = n.goods_id AND n.rn = f.rn + 1)))"""


@query(
    "reorder_plan",
    sql("store_plan", f"SELECT {PLAN_SQL}, dt, receive_day, order_calc, order_num FROM folded WHERE can_order = 1", recursive=True, numbered=NUMBERED,
        folded=REORDERED),
)
def reorder_plan(inp: Inputs) -> DataFrame:
    return rep.reorder_plan(inp.store_plan, PLAN)


CALLOFF = """SELECT wh_dept_id, goods_id, ds AS dt, y AS theory_order_sum, 2 + wh_dept_id % 3 AS lt_cg, CAST(3 AS BIGINT) AS bp_cg, 2e0 AS ss_cg,
  1000e0 AS beg_wh_stock, CASE WHEN dayofyear(ds) % 5 = 0 THEN 300e0 ELSE 0e0 END AS transit, 6000e0 AS po_remain, 60e0 AS pur_use_ratio FROM wh_demand"""


def calloff_input(inp: Inputs) -> DataFrame:
    return inp.wh_demand.select(
        *KEYS,
        F.col("ds").alias("dt"),
        F.col("y").alias("theory_order_sum"),
        (F.col("wh_dept_id") % 3 + 2).alias("lt_cg"),
        F.lit(3).cast("long").alias("bp_cg"),
        F.lit(2.0).alias("ss_cg"),
        F.lit(1000.0).alias("beg_wh_stock"),
        F.when(F.dayofyear("ds") % 5 == 0, 300.0).otherwise(0.0).alias("transit"),
        F.lit(6000.0).alias("po_remain"),
        F.lit(60.0).alias("pur_use_ratio"),
    )


LEADTIME = {
    "calloff": CALLOFF,
    "placed": "SELECT *, row_number() OVER (PARTITION BY wh_dept_id, goods_id ORDER BY dt) AS rn, count(*) OVER (PARTITION BY wh_dept_id, goods_id) AS rows FROM calloff",
    "lead": """SELECT *, bp_lt_consume / (lt_cg + bp_cg) * ss_cg AS ss_amount FROM (
      SELECT a.*, CASE WHEN a.rn + a.lt_cg - 1 <= a.rows THEN (SELECT sum(b.theory_order_sum) FROM placed b WHERE b.wh_dept_id = a.wh_dept_id AND b.goods_id = a.goods_id
          AND b.rn BETWEEN a.rn AND a.rn + a.lt_cg - 1) ELSE 0 END AS lt_consume,
        CASE WHEN a.rn + a.lt_cg + a.bp_cg - 1 <= a.rows THEN (SELECT sum(b.theory_order_sum) FROM placed b WHERE b.wh_dept_id = a.wh_dept_id AND b.goods_id = a.goods_id
          AND b.rn BETWEEN a.rn AND a.rn + a.lt_cg + a.bp_cg - 1) ELSE 0 END AS bp_lt_consume FROM placed a)""",
    "ledger": """SELECT wh_dept_id, goods_id, dt, sum(transit) AS transit FROM (
      SELECT wh_dept_id, goods_id, min(dt) AS dt, max(beg_wh_stock) AS transit FROM calloff GROUP BY 1, 2
      UNION ALL SELECT wh_dept_id, goods_id, dt, transit FROM calloff WHERE transit > 0) GROUP BY 1, 2, 3""",
}


@query("leadtime_demand", sql("wh_demand", f"SELECT wh_dept_id, goods_id, dt, lt_consume, bp_lt_consume, {rounded('ss_amount', 6)} AS ss_amount FROM lead", **{k: LEADTIME[k] for k in ("calloff", "placed", "lead")}))
def leadtime_demand(inp: Inputs) -> DataFrame:
    lead = rep.leadtime_demand(calloff_input(inp), KEYS)
    return lead.select(*KEYS, "dt", "lt_consume", "bp_lt_consume", half_even(F.col("ss_amount"), 6).alias("ss_amount"))


@query("opening_stock_ledger", sql("wh_demand", "SELECT wh_dept_id, goods_id, dt, transit FROM ledger", calloff=CALLOFF, ledger=LEADTIME["ledger"]))
def opening_stock_ledger(inp: Inputs) -> DataFrame:
    return rep.opening_stock_ledger(calloff_input(inp), KEYS, "dt", "beg_wh_stock", "transit")


@query(
    "calloff_plan",
    sql("wh_demand", "SELECT wh_dept_id, goods_id, CAST(dt + CAST(lt_cg AS INTEGER) AS DATE) AS dt, buy AS transit FROM folded WHERE buy > 0", recursive=True, **LEADTIME,
        folded=f"""SELECT l.wh_dept_id, l.goods_id, NULL::DATE AS dt, 0::BIGINT AS lt_cg, 0::BIGINT AS rn, 0e0 AS stock, max(l.po_remain) AS po,
            (SELECT list({{'rd': g.dt, 'q': g.transit}}) FROM ledger g WHERE g.wh_dept_id = l.wh_dept_id AND g.goods_id = l.goods_id) AS held, 0e0 AS buy
          FROM lead l GROUP BY 1, 2
          UNION ALL
          SELECT wh_dept_id, goods_id, dt, lt_cg, rn, greatest(0, stock + rec - theory_order_sum), greatest(0, po - wanted),
            CASE WHEN least(wanted, po) > 0 THEN list_append(held, {{'rd': CAST(dt + CAST(lt_cg AS INTEGER) AS DATE), 'q': least(wanted, po)}}) ELSE held END, least(wanted, po) FROM (
            SELECT *, ceil(greatest(0, greatest(0, bp_lt_consume - lt_consume + ss_amount) - greatest(0, stock + rec + pend - lt_consume)) / pur_use_ratio) * pur_use_ratio AS wanted FROM (
              SELECT l.*, f.stock, f.po, f.held,
                coalesce(list_sum(list_transform(list_filter(f.held, lambda e: e.rd = l.dt), lambda e: e.q)), 0) AS rec,
                coalesce(list_sum(list_transform(list_filter(f.held, lambda e: e.rd > l.dt), lambda e: e.q)), 0) AS pend
              FROM folded f JOIN lead l ON f.wh_dept_id = l.wh_dept_id AND f.goods_id = l.goods_id AND l.rn = f.rn + 1))"""),
)
def calloff_plan(inp: Inputs) -> DataFrame:
    return rep.calloff_plan(calloff_input(inp), KEYS)


@query(
    "warehouse_cover_days",
    sql("wh_demand", """SELECT a.wh_dept_id, a.goods_id, a.ds, CAST(coalesce(max(date_diff('day', a.ds, a.pd)) FILTER (WHERE a.used > 0 AND a.used < a.stock), 0) AS BIGINT) AS wh_avl_days
      FROM (SELECT x.wh_dept_id, x.goods_id, x.ds, x.y * 4.5 AS stock, z.ds AS pd, sum(z.y) OVER (PARTITION BY x.wh_dept_id, x.goods_id, x.ds ORDER BY z.ds) AS used
        FROM wh_demand x JOIN wh_demand z ON x.wh_dept_id = z.wh_dept_id AND x.goods_id = z.goods_id AND z.ds >= x.ds) a GROUP BY 1, 2, 3"""),
)
def warehouse_cover_days(inp: Inputs) -> DataFrame:
    return rep.warehouse_cover_days(inp.wh_demand.withColumn("stock", F.col("y") * 4.5), KEYS, "ds", "stock", "y")


SHOP_DAYS = "SELECT version_id, goods_id, dt, sum(pred_consume) AS pred_consume, sum(stock_end) AS shop_end FROM rolled GROUP BY 1, 2, 3"
SHOP_COVER = """SELECT version_id, goods_id, dt, shop_end, CAST(CASE WHEN mean = 0 THEN 0 ELSE floor(shop_end / mean) END AS BIGINT) AS shop_avl_days FROM (
  SELECT *, avg(pred_consume) OVER (PARTITION BY version_id, goods_id ORDER BY dt ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS mean FROM shop_days)"""


def shop_cover(walked: DataFrame) -> DataFrame:
    days = walked.groupBy("version_id", "goods_id", "dt").agg(F.sum("pred_consume").alias("pred_consume"), F.sum("stock_end").alias("shop_end"))
    return rep.store_cover_days(days, ["version_id", "goods_id"], "dt", "shop_end", "pred_consume")


@query("store_cover_days", sql("store_plan", SHOP_COVER, rolled=ROLLED, shop_days=SHOP_DAYS))
def store_cover_days(inp: Inputs) -> DataFrame:
    return shop_cover(rolled(inp.store_plan)).select("version_id", "goods_id", "dt", "shop_end", "shop_avl_days")


IN_STOCK = """SELECT version_id, goods_id, dt, CAST(sum(CAST(stock_beg + expected_receive > 0 AS BIGINT)) AS BIGINT) AS in_stock, max(shop_cnt) AS shop_cnt,
  sum(CAST(stock_beg + expected_receive > 0 AS BIGINT)) / max(shop_cnt) AS shop_avl_rate FROM (
    SELECT r.*, c.shop_cnt FROM rolled r JOIN (SELECT version_id, goods_id, count(DISTINCT dept_id) AS shop_cnt FROM store_plan GROUP BY 1, 2) c
    ON r.version_id = c.version_id AND r.goods_id = c.goods_id) WHERE closed = 0 GROUP BY 1, 2, 3"""


def in_stock(walked: DataFrame) -> DataFrame:
    return rep.in_stock_rate(walked, ["version_id", "goods_id"], "dt", "dept_id", F.col("stock_beg") + F.col("expected_receive"))


@query("in_stock_rate", sql("store_plan", f"SELECT version_id, goods_id, dt, in_stock, shop_cnt, {rounded('shop_avl_rate', 5)} AS shop_avl_rate FROM rate", rolled=ROLLED, rate=IN_STOCK))
def in_stock_rate(inp: Inputs) -> DataFrame:
    return in_stock(rolled(inp.store_plan)).withColumn("shop_avl_rate", half_even(F.col("shop_avl_rate"), 5))


LAYERS = ["po1_amount", "po2_amount", "po3_amount"]
SHARES = {"po1_amount": 0.3, "po2_amount": 0.2, "po3_amount": 0.4}
DRAWN = {
    "nation": "SELECT goods_id, ds AS dt, sum(y) AS theory_order_sum FROM wh_demand GROUP BY 1, 2",
    "layers": f"""SELECT goods_id, {', '.join(f'round_even(sum(theory_order_sum) * {s}e0 * (0.5e0 + 0.3e0 * goods_id), 0) AS {c}' for c, s in SHARES.items())},
      60e0 AS pur_use_ratio, CAST(min(dt) + CAST(8 * (goods_id + 1) AS INTEGER) AS DATE) AS expire_day FROM nation GROUP BY goods_id""",
    "drawn": """SELECT *, greatest(0, po1_amount - dly_sum) AS po1_amount_remain, greatest(0, po2_amount - greatest(0, dly_sum - po1_amount)) AS po2_amount_remain,
        greatest(0, po3_amount - greatest(0, dly_sum - po1_amount - po2_amount)) AS po3_amount_remain FROM (
      SELECT n.*, l.po1_amount, l.po2_amount, l.po3_amount, l.pur_use_ratio, l.expire_day, sum(theory_order_sum) OVER (PARTITION BY n.goods_id ORDER BY dt) AS dly_sum
      FROM nation n JOIN layers l ON n.goods_id = l.goods_id)""",
}


def drawn(inp: Inputs) -> DataFrame:
    nation = series.daily_sum(inp.wh_demand, ["goods_id"], "ds", "y", "theory_order_sum").withColumnRenamed("ds", "dt")
    nation = staged(nation, "nation-demand")
    total, size = F.sum("theory_order_sum"), F.lit(0.5) + F.lit(0.3) * F.col("goods_id")
    layers = nation.groupBy("goods_id").agg(
        *(F.rint(total * s * size).alias(c) for c, s in SHARES.items()),
        F.lit(60.0).alias("pur_use_ratio"),
        F.date_add(F.min("dt"), (8 * (F.col("goods_id") + 1)).cast("int")).alias("expire_day"),
    )
    days = win.running_total(nation, ["goods_id"], "dt", "theory_order_sum", "dly_sum").join(layers, "goods_id")
    return rep.layered_drawdown(days, LAYERS, "dly_sum")


@query("layered_drawdown", sql("wh_demand", "SELECT goods_id, dt, dly_sum, po1_amount_remain, po2_amount_remain, po3_amount_remain FROM drawn", **DRAWN))
def layered_drawdown(inp: Inputs) -> DataFrame:
    return drawn(inp).select("goods_id", "dt", "dly_sum", *(f"{c}_remain" for c in LAYERS))


def end_sql(n: int) -> str:
    """End of layer ``n`` from the ends of the layer before it."""
    start = "dt_end" if n == 1 else f"greatest(po{n - 1}_amount_end, dt_end)"
    end = f"CASE WHEN z{n} IS NOT NULL THEN greatest(z{n}, {start}) ELSE CAST({start} + CAST(ceil(left{n} / last_seven) AS INTEGER) AS DATE) END"
    return end if n == 1 else f"CASE WHEN po{n}_amount = 0 THEN greatest({end}, po{n - 1}_amount_end) ELSE {end} END"


ENDS = {
    **DRAWN,
    "ends0": f"""SELECT goods_id, min(dt) AS dt_start, max(dt) AS dt_end, max(pur_use_ratio) AS pur_use_ratio, max(expire_day) AS expire_day,
        {', '.join(f'min(dt) FILTER (WHERE po{n}_amount_remain = 0) AS z{n}, arg_max(po{n}_amount_remain, dt) AS left{n}, max(po{n}_amount) AS po{n}_amount' for n in (1, 2, 3))},
        (SELECT avg(theory_order_sum) FROM (SELECT theory_order_sum FROM nation q WHERE q.goods_id = d.goods_id AND theory_order_sum > 0 ORDER BY dt DESC LIMIT 7)) AS last_seven
      FROM drawn d GROUP BY goods_id""",
    "ends1": f"SELECT *, {end_sql(1)} AS po1_amount_end FROM ends0",
    "ends2": f"SELECT *, {end_sql(2)} AS po2_amount_end FROM ends1",
    "ends": f"SELECT *, {end_sql(3)} AS po3_amount_end FROM ends2",
}


def ends(inp: Inputs) -> DataFrame:
    days = drawn(inp)
    dates = rep.depletion_dates(days, ["goods_id"], "dt", LAYERS, "theory_order_sum")
    facts = days.groupBy("goods_id").agg(
        F.max("pur_use_ratio").alias("pur_use_ratio"),
        F.max("expire_day").alias("expire_day"),
        F.coalesce(F.sum(F.when(F.col("dt") < F.col("expire_day"), F.col("theory_order_sum"))), F.lit(0.0)).alias("consumed"),
    )
    return dates.join(facts, "goods_id")


@query(
    "depletion_dates",
    sql("wh_demand", """SELECT goods_id, po1_amount_end AS first_deadline, po2_amount_end AS goods_deadline, po3_amount_end AS raw_deadline,
        ceil(po1_amount / pur_use_ratio) AS first_delivery_quantity, CAST(date_diff('day', dt_start, po1_amount_end) AS INTEGER) AS first_delivery_days,
        CAST(date_diff('day', po1_amount_end, po2_amount_end) AS INTEGER) AS goods_stock_up_days, CAST(date_diff('day', po2_amount_end, po3_amount_end) AS INTEGER) AS raw_stock_days,
        CAST(date_diff('day', dt_start, po3_amount_end) AS INTEGER) AS total_days FROM ends""", **ENDS),
)
def depletion_dates(inp: Inputs) -> DataFrame:
    first, goods, raw = (F.col(f"{c}_end") for c in LAYERS)
    return ends(inp).select(
        "goods_id",
        first.alias("first_deadline"),
        goods.alias("goods_deadline"),
        raw.alias("raw_deadline"),
        F.ceil(F.col("po1_amount") / F.col("pur_use_ratio")).cast("double").alias("first_delivery_quantity"),
        F.date_diff(first, F.col("dt_start")).alias("first_delivery_days"),
        F.date_diff(goods, first).alias("goods_stock_up_days"),
        F.date_diff(raw, goods).alias("raw_stock_days"),
        F.date_diff(raw, F.col("dt_start")).alias("total_days"),
    )


@query(
    "expiry_risk",
    sql("wh_demand", """SELECT goods_id, expired AS estimated_expired_quantity, CAST(expired <> 0 AS BIGINT) AS is_expire_risk,
        ceil((left1 + left2 + left3) / pur_use_ratio) AS over_plan_quantity, CAST(date_diff('day', dt_start, dt_end) + 1 AS INTEGER) AS plan_sale_duration FROM (
      SELECT *, ceil(CASE WHEN expire_day <= dt_end THEN po1_amount + po2_amount + po3_amount - consumed
          WHEN expire_day < po3_amount_end THEN po1_amount + po2_amount + po3_amount - consumed - date_diff('day', expire_day, po3_amount_end) * last_seven
          ELSE 0 END / pur_use_ratio) AS expired FROM (
        SELECT e.*, (SELECT coalesce(sum(theory_order_sum), 0) FROM nation n WHERE n.goods_id = e.goods_id AND n.dt < e.expire_day) AS consumed FROM ends e))""", **ENDS),
)
def expiry_risk(inp: Inputs) -> DataFrame:
    risk = rep.expiry_risk(ends(inp), F.col("consumed"), LAYERS, "po3_amount")
    duration = (F.date_diff("dt_end", "dt_start") + 1).alias("plan_sale_duration")
    return risk.select("goods_id", "estimated_expired_quantity", "is_expire_risk", "over_plan_quantity", duration)


BANDS = """SELECT version_id, goods_id, wh_dept_id, pur_use_ratio, sum(order_num) FILTER (WHERE dt <= e1) AS po1_amount,
    coalesce(sum(order_num) FILTER (WHERE dt > e1 AND dt <= e2), 0) AS po2_amount, coalesce(sum(order_num) FILTER (WHERE dt > e2 AND dt <= e3), 0) AS po3_amount FROM (
  SELECT version_id, goods_id, wh_dept_id, 60e0 AS pur_use_ratio, dt, pred_consume AS order_num, e1, CAST(e1 + 5 AS DATE) AS e2, CAST(e1 + 5 + CAST(7 AS INTEGER) AS DATE) AS e3 FROM (
    SELECT *, CAST(DATE '2023-12-26' + CAST(goods_id * 2 + 3 + wh_dept_id % 2 AS INTEGER) AS DATE) AS e1 FROM store_plan)) GROUP BY 1, 2, 3, 4 HAVING count(*) FILTER (WHERE dt <= e1) > 0"""


def bands(inp: Inputs) -> DataFrame:
    """Launch two days later per goods; the first goods sell out before the first plan day and drop out."""
    params = inp.store_plan.select(
        "version_id", "goods_id", "wh_dept_id", "dt", F.col("pred_consume").alias("order_num"),
        F.lit(60.0).alias("pur_use_ratio"), F.lit(3).alias("wh_bp"), (F.col("wh_dept_id") % 2).alias("wh_lt"),
        F.lit(5).alias("pt"), F.lit(7).alias("mt"),
        F.date_add(F.lit("2023-12-26").cast("date"), (F.col("goods_id") * 2).cast("int")).alias("launch"),
    )
    keys = ["version_id", "goods_id", "wh_dept_id", "pur_use_ratio"]
    return rep.stockup_bands(params, keys, "dt", F.col("launch"), "order_num")


@query("stockup_bands", sql("store_plan", BANDS))
def stockup_bands(inp: Inputs) -> DataFrame:
    return bands(inp)


@query(
    "proportional_alloc",
    sql("store_plan", f"""SELECT version_id, goods_id, wh_dept_id, {rounded('need / total', 6)} AS dis_ratio, round_even(1000 * (need / total), 0) * pur_use_ratio AS dis_supplier_stock,
        po3_amount + round_even(1000 * (need / total), 0) * pur_use_ratio AS po3_amount FROM (
      SELECT *, po1_amount + po2_amount + po3_amount AS need, sum(po1_amount + po2_amount + po3_amount) OVER (PARTITION BY version_id) AS total FROM bands)""", bands=BANDS),
)
def proportional_alloc(inp: Inputs) -> DataFrame:
    need = F.col("po1_amount") + F.col("po2_amount") + F.col("po3_amount")
    shared = rep.proportional_allocation(bands(inp), ["version_id"], need, F.lit(1000.0), "units")
    stock = F.col("units") * F.col("pur_use_ratio")
    return shared.select(
        "version_id", "goods_id", "wh_dept_id", half_even(F.col("dis_ratio"), 6).alias("dis_ratio"),
        stock.alias("dis_supplier_stock"), (F.col("po3_amount") + stock).alias("po3_amount"),
    )


@query(
    "weekly_cups",
    sql("store_plan", "SELECT version_id, goods_id, " + ", ".join(f"{rounded(f'''avg(pred_consume) FILTER (WHERE week_label = 'W{k}') / 1.7''', 2)} AS w{k}" for k in (1, 2, 3, 4))
        + " FROM (SELECT *, 'W' || CAST((dayofyear(dt) - 1) // 7 + 1 AS VARCHAR) AS week_label FROM store_plan) GROUP BY 1, 2"),
)
def weekly_cups(inp: Inputs) -> DataFrame:
    week = F.concat(F.lit("w"), F.floor((F.dayofyear("dt") - 1) / 7 + 1).cast("string"))
    cups = half_even(F.avg("pred_consume") / 1.7, 2)
    return agg.pivot_labels(inp.store_plan.withColumn("week", week), ["version_id", "goods_id"], "week", ["w1", "w2", "w3", "w4"], cups)


@query(
    "reorder_factor",
    f"""SELECT version_id, dept_id, wh_dept_id, goods_id, ct_bp_days, ct_last_order_day, first_week_consume, target_consume,
          CASE WHEN raw < 2 THEN 2e0 WHEN raw > 100 THEN 100e0 ELSE raw END AS ro FROM (
          SELECT *, {rounded('target_consume / first_week_consume * (ct_bp_days + 1) - ct_bp_days', 2)} AS raw FROM (
            SELECT v.version_id, c_custkey AS dept_id, c_custkey % 5 AS wh_dept_id, CAST(n_regionkey AS BIGINT) AS goods_id, 1 + c_custkey % 4 AS ct_bp_days,
              CAST(DATE '2024-01-01' + CAST(c_custkey % 7 AS INTEGER) AS DATE) AS ct_last_order_day,
              sum((1 + n_nationkey % 3) * (1 + c_custkey % 4) * 0.25e0 * (10 + n_nationkey)) AS first_week_consume,
              sum((1 + n_nationkey % 3) * (1 + c_custkey % 4) * 0.25e0 * (10 + n_nationkey + 15 * v.version_id)) AS target_consume
            FROM customer JOIN nation ON c_nationkey % 5 = n_nationkey % 5, (SELECT unnest([1::BIGINT, 2::BIGINT]) AS version_id) v GROUP BY ALL))""",
)
def reorder_factor(inp: Inputs) -> DataFrame:
    customer, nation = inp.table("customer"), inp.table("nation")
    key = F.col("c_custkey")
    base = customer.select(
        key.alias("dept_id"), (key % 5).alias("wh_dept_id"), (1 + key % 4).alias("ct_bp_days"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 7).cast("int")).alias("ct_last_order_day"),
    )
    menu = customer.select(key.alias("dept_id"), (F.col("c_nationkey") % 5).alias("_menu"), ((1 + key % 4) * 0.25).alias("dis_ratio"))
    ratio = menu.join(nation.select((F.col("n_nationkey") % 5).alias("_menu"), F.col("n_nationkey").alias("commodity_id")), "_menu")
    commodity = F.col("n_nationkey")
    formula = nation.select(commodity.alias("commodity_id"), F.col("n_regionkey").cast("long").alias("goods_id"), (1 + commodity % 3).alias("sku_average_number"))
    version = F.explode(F.array(F.lit(1).cast("long"), F.lit(2).cast("long"))).alias("version_id")
    strategy = nation.select(commodity.alias("commodity_id"), version).select(
        "commodity_id", "version_id", (10 + F.col("commodity_id")).alias("first_week_cup_quantity_avg"),
        (10 + F.col("commodity_id") + 15 * F.col("version_id")).alias("target_value"),
    )
    return rep.reorder_factor(base, formula, strategy, ratio.drop("_menu"))


CALENDARS = {
    "daily": "SELECT dept_id, goods_id, version_id, wh_dept_id, dt AS predict_date, pred_consume AS shop_com_consume FROM store_plan",
    "chance": """SELECT dt, dept_id, goods_id, CAST(1 + CAST(dept_id % 4 = 0 AND dayofyear(dt) % 2 = 0 AS INTEGER) AS BIGINT) AS order_cnt, can_order, closed,
      CASE WHEN dept_id % 10 = 9 AND dayofyear(dt) % 2 = 1 THEN NULL ELSE receive_day END AS receive_day,
      CAST(DATE '2024-01-05' + CAST(goods_id AS INTEGER) AS DATE) AS min_launch_date FROM store_plan WHERE version_id = 1""",
    "covered": "SELECT dt, dept_id, CAST(dt + CAST(h AS INTEGER) AS DATE) AS predict_date FROM (SELECT DISTINCT dt, dept_id FROM store_plan), range(0, 3) r(h)",
    "bp": """SELECT c.dt, c.dept_id, h.goods_id, d.version_id, sum(CASE WHEN can_order = 0 THEN 0 ELSE shop_com_consume END) AS bp_consume
      FROM covered c JOIN chance h ON c.dt = h.dt AND c.dept_id = h.dept_id JOIN daily d ON c.dept_id = d.dept_id AND h.goods_id = d.goods_id AND c.predict_date = d.predict_date GROUP BY 1, 2, 3, 4""",
    "vlt": """SELECT c.dt, c.dept_id, h.goods_id, d.version_id, sum(CASE WHEN c.predict_date < min_launch_date THEN 0 ELSE shop_com_consume END) AS vlt_consume
      FROM covered c JOIN chance h ON c.dt = h.dt AND c.dept_id = h.dept_id JOIN daily d ON c.dept_id = d.dept_id AND h.goods_id = d.goods_id AND c.predict_date = d.predict_date GROUP BY 1, 2, 3, 4""",
}


class Calendars:
    """Order calendar, order chances and daily consumption behind the plan base."""

    def __init__(self, plan: DataFrame):
        odd = F.dayofyear("dt") % 2
        self.daily = plan.select("dept_id", "goods_id", "version_id", "wh_dept_id", F.col("dt").alias("predict_date"), F.col("pred_consume").alias("shop_com_consume"))
        self.chance = plan.where(F.col("version_id") == 1).select(
            "dt", "dept_id", "goods_id",
            (1 + ((F.col("dept_id") % 4 == 0) & (odd == 0)).cast("long")).alias("order_cnt"),
            "can_order", "closed",
            F.when(~((F.col("dept_id") % 10 == 9) & (odd == 1)), F.col("receive_day")).alias("receive_day"),
            F.date_add(F.lit("2024-01-05").cast("date"), F.col("goods_id").cast("int")).alias("min_launch_date"),
        )
        days = plan.select("dt", "dept_id").distinct()
        self.covered = days.withColumn("predict_date", F.explode(F.sequence(F.col("dt"), F.date_add("dt", 2))))

    def consumed(self) -> DataFrame:
        void = {"bp_consume": F.col("can_order") == 0, "vlt_consume": F.col("predict_date") < F.col("min_launch_date")}
        return rep.calendar_consumption(self.covered, self.chance, self.daily, void)


@query(
    "calendar_consumption",
    sql("store_plan", """SELECT b.dt, b.dept_id, b.goods_id, b.version_id, b.bp_consume, v.vlt_consume FROM bp b JOIN vlt v
      ON b.dt = v.dt AND b.dept_id = v.dept_id AND b.goods_id = v.goods_id AND b.version_id = v.version_id""", **CALENDARS),
)
def calendar_consumption(inp: Inputs) -> DataFrame:
    cal = Calendars(inp.plan_of(staged(inp.store_demand, "store-demand")))
    return cal.consumed()


@query(
    "launch_type",
    """SELECT p_brand, p_size, lo AS min_launch_date, hi AS max_launch_date, CAST(CASE WHEN hi = lo THEN 1 WHEN date_diff('day', lo, hi) <= 11 THEN 2 ELSE 3 END AS BIGINT) AS new_type,
         CAST(lo - 11 AS DATE) AS min_cs_start FROM (SELECT p_brand, p_size, min(d) AS lo, max(d) AS hi FROM
         (SELECT *, CAST(DATE '2024-01-01' + CAST(p_partkey % 20 AS INTEGER) AS DATE) AS d FROM part) GROUP BY 1, 2)""",
)
def launch_type(inp: Inputs) -> DataFrame:
    launch = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("p_partkey") % 20).cast("int"))
    return rep.launch_type(inp.table("part").withColumn("launch", launch), ["p_brand", "p_size"], "launch", 11)


@query(
    "safety_reorder_level",
    sql("store_plan", """SELECT s.version_id, s.dept_id, s.goods_id, s.dt, CASE WHEN p.ss IS NOT NULL THEN p.ss + p.ro * s.pred_consume END AS ss_ro,
        coalesce(s.bp_consume / 3 * p.ro, 0) AS bp_level FROM store_plan s LEFT JOIN (
        SELECT coalesce(a.dept_id, b.dept_id) AS dept_id, coalesce(a.goods_id, b.goods_id) AS goods_id, coalesce(ss, 0e0) AS ss, coalesce(ro, 0e0) AS ro
        FROM (SELECT user_id AS dept_id, event_id % 5 AS goods_id, CAST(count(*) AS DOUBLE) AS ss FROM events WHERE event_type = 'click' GROUP BY 1, 2) a
        FULL JOIN (SELECT user_id AS dept_id, event_id % 5 AS goods_id, count(*) / 2 AS ro FROM events WHERE event_type = 'view' GROUP BY 1, 2) b
        ON a.dept_id = b.dept_id AND a.goods_id = b.goods_id) p ON s.dept_id = p.dept_id AND s.goods_id = p.goods_id"""),
)
def safety_reorder_level(inp: Inputs) -> DataFrame:
    keys = ["dept_id", "goods_id"]
    events = inp.table("events").select(F.col("user_id").alias("dept_id"), (F.col("event_id") % 5).alias("goods_id"), "event_type")
    safety = events.where(F.col("event_type") == "click").groupBy(*keys).agg(F.count("*").cast("double").alias("ss"))
    factor = events.where(F.col("event_type") == "view").groupBy(*keys).agg((F.count("*") / 2).alias("ro"))
    joined = inp.store_plan.drop("ss_ro").join(outer_filled(safety, factor, keys), keys, "left")
    return joined.select(
        *PLAN, "dt",
        (F.col("ss") + F.col("ro") * F.col("pred_consume")).alias("ss_ro"),
        F.coalesce(F.col("bp_consume") / 3 * F.col("ro"), F.lit(0.0)).alias("bp_level"),
    )


SPECS = {
    "specs": """SELECT s_suppkey % 5 AS wh_dept_id, CAST(s_nationkey % 4 AS BIGINT) AS goods_id, CAST(s_suppkey % 3 = 0 AS INTEGER) AS city_purchase_status,
      CAST(5 + s_suppkey % 4 * 5 AS DOUBLE) AS dly_use_ratio, CAST(10 + s_suppkey % 2 * 2 AS DOUBLE) AS pur_dly_ratio FROM supplier""",
    "config": "SELECT CAST(r_regionkey AS BIGINT) AS goods_id, 8e0 AS dly_use_ratio, 12e0 AS pur_dly_ratio FROM region",
    "resolved": """SELECT k.wh_dept_id, k.goods_id, coalesce(v.dly, n.dly, c.dly_use_ratio) AS dly_use_ratio, coalesce(v.pur, n.pur, c.pur_dly_ratio) AS pur_dly_ratio
      FROM (SELECT DISTINCT wh_dept_id, goods_id FROM store_demand) k
      LEFT JOIN (SELECT wh_dept_id, goods_id, max(dly_use_ratio) AS dly, max(pur_dly_ratio) AS pur FROM specs WHERE city_purchase_status = 1 GROUP BY 1, 2) v ON k.wh_dept_id = v.wh_dept_id AND k.goods_id = v.goods_id
      LEFT JOIN (SELECT goods_id, max(dly_use_ratio) AS dly, max(pur_dly_ratio) AS pur FROM specs GROUP BY 1) n ON k.goods_id = n.goods_id
      LEFT JOIN config c ON k.goods_id = c.goods_id""",
}


def specs(inp: Inputs, pairs: DataFrame) -> DataFrame:
    key = F.col("s_suppkey")
    rows = inp.table("supplier").select(
        (key % 5).alias("wh_dept_id"), (F.col("s_nationkey") % 4).cast("long").alias("goods_id"),
        (key % 3 == 0).cast("int").alias("city_purchase_status"),
        (5 + key % 4 * 5).cast("double").alias("dly_use_ratio"), (10 + key % 2 * 2).cast("double").alias("pur_dly_ratio"),
    )
    config = inp.table("region").select(F.col("r_regionkey").cast("long").alias("goods_id"), F.lit(8.0).alias("dly_use_ratio"), F.lit(12.0).alias("pur_dly_ratio"))
    return rep.resolved_specs(pairs.select(*KEYS).distinct(), rows, config)


@query("spec_fallback", sql("store_demand", "SELECT * FROM resolved", **SPECS))
def spec_fallback(inp: Inputs) -> DataFrame:
    return specs(inp, inp.store_demand)


@query(
    "replenish_gap",
    sql("wh_demand", """SELECT wh_dept_id, goods_id, need, po_zt, cg_zt, ceil(greatest(0, need - po_zt - cg_zt - beg_wh_stock) / 60) * 60 AS pp_zt FROM (
      SELECT *, round_even(9000 * (need / sum(need) OVER ()), 0) AS po_zt FROM (
        SELECT wh_dept_id, goods_id, sum(y) AS need, coalesce(sum(y) FILTER (WHERE dayofyear(ds) % 6 = 0), 0) AS cg_zt, 100e0 * (1 + wh_dept_id) AS beg_wh_stock FROM wh_demand GROUP BY 1, 2))"""),
)
def replenish_gap(inp: Inputs) -> DataFrame:
    """Purchase transit is shared out by need, then all cover is taken off the need."""
    in_transit = F.when(F.dayofyear("ds") % 6 == 0, F.col("y"))
    need = inp.wh_demand.groupBy(*KEYS).agg(F.sum("y").alias("need"), F.coalesce(F.sum(in_transit), F.lit(0.0)).alias("cg_zt"))
    shared = rep.proportional_allocation(need, [], F.col("need"), F.lit(9000.0), "po_zt")
    stock = F.lit(100.0) * (1 + F.col("wh_dept_id"))
    gap = rep.replenish_gap(F.col("need"), [F.col("po_zt"), F.col("cg_zt"), stock], F.lit(60.0))
    return shared.select(*KEYS, "need", "po_zt", "cg_zt", gap.alias("pp_zt"))


@query(
    "plan_base",
    sql("store_plan", f"""SELECT l.dt, l.goods_id, d.dept_id, d.version_id, d.wh_dept_id, h.receive_day, h.closed, CASE WHEN h.order_cnt > 1 THEN 0 ELSE h.can_order END AS can_order,
        CASE WHEN l.dt < h.min_launch_date THEN 0 ELSE d.shop_com_consume END AS pred_consume, coalesce(b.bp_consume, 0) AS bp_consume, coalesce(v.vlt_consume, 0) AS vlt_consume,
        coalesce(coalesce(b.bp_consume, 0) / coalesce(y.bp_days, 1e0) * coalesce(f.ro, 3e0), 0) AS ss_ro, s.dly_use_ratio, s.pur_dly_ratio, 0e0 AS shop_beg
      FROM labels l LEFT JOIN daily d ON l.dt = d.predict_date AND l.goods_id = d.goods_id LEFT JOIN chance h ON l.dt = h.dt AND d.dept_id = h.dept_id AND l.goods_id = h.goods_id
      LEFT JOIN bp b ON l.dt = b.dt AND d.dept_id = b.dept_id AND l.goods_id = b.goods_id AND d.version_id = b.version_id
      LEFT JOIN vlt v ON l.dt = v.dt AND d.dept_id = v.dept_id AND l.goods_id = v.goods_id AND d.version_id = v.version_id
      LEFT JOIN (SELECT DISTINCT dept_id, CASE WHEN dept_id % 3 <> 0 THEN 2e0 END AS bp_days FROM store_plan) y ON d.dept_id = y.dept_id
      LEFT JOIN (SELECT dt, dept_id, goods_id, version_id, 2 + dept_id % 3 * 0.5e0 AS ro FROM store_plan WHERE dayofyear(dt) = 27) f
        ON l.dt = f.dt AND d.dept_id = f.dept_id AND l.goods_id = f.goods_id AND d.version_id = f.version_id
      JOIN resolved s ON d.wh_dept_id = s.wh_dept_id AND l.goods_id = s.goods_id WHERE h.receive_day IS NOT NULL""",
        **CALENDARS, **SPECS, labels="SELECT DISTINCT dt, goods_id FROM store_plan"),
)
def plan_base(inp: Inputs) -> DataFrame:
    plan = inp.plan_of(staged(inp.store_demand, "store-demand"))
    cal = Calendars(plan)
    # Every third store has no cover period of its own.
    bp_days = plan.select("dept_id").distinct().withColumn("bp_days", F.when(F.col("dept_id") % 3 != 0, 2.0))
    factors = plan.where(F.dayofyear("dt") == 27).select("dt", *PLAN, (2 + F.col("dept_id") % 3 * 0.5).alias("ro"))
    base = rep.plan_base(cal.daily, plan.select("dt", "goods_id").distinct(), cal.chance, cal.consumed(), bp_days, factors, specs(inp, plan), 3.0)
    return base.select(
        "dt", "goods_id", "dept_id", "version_id", "wh_dept_id", "receive_day", "closed", F.col("can_order").cast("long").alias("can_order"),
        "pred_consume", "bp_consume", "vlt_consume", "ss_ro", "dly_use_ratio", "pur_dly_ratio", "shop_beg",
    )


@query(
    "version_outflow",
    sql("store_plan", """SELECT dt, version_id, goods_id, wh_dept_id, theory_order_sum, 2 + wh_dept_id AS lt_cg, po2_amount + po3_amount AS po_remain FROM (
      SELECT dt, version_id, goods_id, wh_dept_id, sum(pred_consume) AS theory_order_sum FROM store_plan GROUP BY 1, 2, 3, 4) JOIN
      (SELECT wh_dept_id, goods_id, round_even(sum(y) * 0.2e0, 0) AS po2_amount, round_even(sum(y) * 0.4e0, 0) AS po3_amount FROM store_demand GROUP BY 1, 2) USING (wh_dept_id, goods_id)"""),
)
def version_outflow(inp: Inputs) -> DataFrame:
    base = inp.store_demand.groupBy(*KEYS).agg(F.rint(F.sum("y") * 0.2).alias("po2_amount"), F.rint(F.sum("y") * 0.4).alias("po3_amount"))
    base = base.withColumns({"wt": F.lit(2), "vlt_cg": F.col("wh_dept_id")})
    orders = inp.store_plan.withColumnRenamed("pred_consume", "order_num")
    return rep.version_outflow(orders, base).select("dt", "version_id", "goods_id", "wh_dept_id", "theory_order_sum", "lt_cg", "po_remain")


@query(
    "availability_mart",
    sql("store_plan", f"""SELECT strftime(c.dt, '%Y-%m-%d') AS predict_dt, CAST(c.goods_id AS INTEGER) AS goods_id, 1::INTEGER AS material_type, 1::INTEGER AS scene, 1::INTEGER AS stock_up_version,
        CAST(c.version_id AS INTEGER) AS consumer_version, 7::INTEGER AS strategy_version_id, 3::INTEGER AS sim_version, {rounded('coalesce(CASE WHEN dayofyear(c.dt) <= 5 AND year(c.dt) = 2024 THEN 0.9e0 END, r.shop_avl_rate, 0)', 5)} AS shop_avl_rate,
        CAST(coalesce(w.wh_avl_days, 0) AS INTEGER) AS wh_avl_days, CAST(coalesce(s.shop_avl_days, 0) AS INTEGER) AS shop_avl_days, 5e0 AS dly_use_ratio, 60e0 AS pur_use_ratio,
        CAST(c.dt = DATE '2024-01-05' AS INTEGER) AS is_min_launch_day, coalesce(o.pred_consume, 0) AS shop_consume_amount, coalesce(o.order_num, 0) AS wh_consume_amount
      FROM (SELECT version_id, goods_id, CAST(unnest(generate_series(min(dt) - INTERVAL 11 DAY, max(dt), INTERVAL 1 DAY)) AS DATE) AS dt FROM store_plan GROUP BY 1, 2) c
      LEFT JOIN rate r ON c.version_id = r.version_id AND c.goods_id = r.goods_id AND c.dt = r.dt LEFT JOIN shop s ON c.version_id = s.version_id AND c.goods_id = s.goods_id AND c.dt = s.dt
      LEFT JOIN cover w ON c.version_id = w.version_id AND c.goods_id = w.goods_id AND c.dt = w.dt LEFT JOIN outflow o ON c.version_id = o.version_id AND c.goods_id = o.goods_id AND c.dt = o.dt""",
        rolled=ROLLED, rate=IN_STOCK, shop_days=SHOP_DAYS, shop=SHOP_COVER,
        outflow="SELECT version_id, goods_id, dt, sum(pred_consume) AS pred_consume, sum(bp_consume) AS order_num FROM store_plan GROUP BY 1, 2, 3",
        cover="""SELECT version_id, goods_id, dt, coalesce(max(date_diff('day', dt, pd)) FILTER (WHERE used > 0 AND used < stock), 0) AS wh_avl_days FROM (
          SELECT x.version_id, x.goods_id, x.dt, x.pred_consume * 10 AS stock, z.dt AS pd, sum(z.order_num) OVER (PARTITION BY x.version_id, x.goods_id, x.dt ORDER BY z.dt) AS used
          FROM outflow x JOIN outflow z ON x.version_id = z.version_id AND x.goods_id = z.goods_id AND z.dt >= x.dt) GROUP BY 1, 2, 3"""),
)
def availability_mart(inp: Inputs) -> DataFrame:
    group, keys = ["version_id", "goods_id"], ["version_id", "goods_id", "dt"]
    plan = inp.plan_of(staged(inp.store_demand, "store-demand"))
    outflow = plan.groupBy(*keys).agg(F.sum("pred_consume").alias("pred_consume"), F.sum("bp_consume").alias("order_num"))
    cover = rep.warehouse_cover_days(outflow.withColumn("stock", F.col("pred_consume") * 10), group, "dt", "stock", "order_num")
    first, last = series.time_bounds(plan, "dt")
    days = series.calendar(plan, group, F.date_sub(first, 11), last, "dt")
    recorded = outflow.where((F.dayofyear("dt") <= 5) & (F.year("dt") == 2024)).select(*keys, F.lit(0.9).alias("shop_actual_avl_rate"))
    tags = {n: F.lit(v) for n, v in {"material_type": 1, "scene": 1, "stock_up_version": 1, "strategy_version_id": 7, "sim_version": 3, "dly_use_ratio": 5, "pur_use_ratio": 60}.items()}
    tags |= {"consumer_version": F.col("version_id"), "is_min_launch_day": (F.col("dt") == F.lit("2024-01-05").cast("date")).cast("int")}
    walked = staged(rolled(plan), "walked")
    facts = [in_stock(walked).select(*keys, "shop_avl_rate"), shop_cover(walked).select(*keys, "shop_avl_days"), cover, outflow]
    return sinks.apply_contract(rep.availability_mart(days, facts, recorded, keys, tags), sinks.AVAILABILITY)
