"""Queries: accuracy, model choice and accuracy marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockwise.functions.numeric import BAND_LABELS, half_even
from stockwise.operators import accuracy as acc
from stockwise.operators import aggregate as agg
from stockwise.operators import forecast as fc
from stockwise.operators import selection as sel
from stockwise.operators import series
from stockwise.operators import windows as win
from stockwise.plans.aggregating import BAND_COUNTS, BAND_RATIOS
from stockwise.plans.columns import BAND_CASE
from stockwise.plans.inputs import KEYS, Inputs, dense_sql, goods_number, priced, rounded, sql
from stockwise.plans.registry import query
from stockwise.session import staged

EPS = "2.220446049250313e-16"

MONEY = {
    "pairs": f"""SELECT k.wh_dept_id, k.goods_id, coalesce(p.unit_price, g.m, w.m) AS unit_price FROM (SELECT DISTINCT wh_dept_id, goods_id FROM evaluated) k
        LEFT JOIN unit_price p ON k.wh_dept_id = p.wh_dept_id AND k.goods_id = p.goods_id
        LEFT JOIN (SELECT goods_id, {rounded('avg(unit_price)', 4)} AS m FROM unit_price GROUP BY 1) g ON k.goods_id = g.goods_id
        LEFT JOIN (SELECT wh_dept_id, {rounded('avg(unit_price)', 4)} AS m FROM unit_price GROUP BY 1) w ON k.wh_dept_id = w.wh_dept_id""",
    "daily_money": f"""SELECT e.*, {rounded('e.y * p.unit_price', 1)} AS y_price, {rounded('e.predict_demand * p.unit_price', 1)} AS pred_price
        FROM evaluated e JOIN pairs p ON e.wh_dept_id = p.wh_dept_id AND e.goods_id = p.goods_id""",
    "totals": f"""SELECT model, dt, wh_dept_id, goods_id, {rounded('sum(y)', 1)} AS y, {rounded('sum(predict_demand)', 1)} AS predict_demand
        FROM evaluated GROUP BY 1, 2, 3, 4""",
    "month_money": f"""SELECT e.*, {rounded('e.y * p.unit_price', 1)} AS y_price, {rounded('e.predict_demand * p.unit_price', 1)} AS pred_price
        FROM totals e JOIN pairs p ON e.wh_dept_id = p.wh_dept_id AND e.goods_id = p.goods_id""",
}


def metric_sql(source: str, grain: str = "") -> str:
    """Metrics per run day and model at three grains, or at the named one."""
    diff = "CAST(round_even(abs(pred_price - y_price) * 1e6, 0) AS HUGEINT)"
    where = f"WHERE grain = '{grain}'" if grain else ""
    return f"""SELECT *, {rounded('1 - MAPE', 4)} AS ACC FROM (
      SELECT dt, model, wh_dept_id, goods_id, {rounded(f'CAST(sum({diff} * {diff}) AS DOUBLE) / count(*) / 1e12', 4)} AS MSE,
        {rounded(f'CAST(sum({diff}) AS DOUBLE) / count(*) / 1e6', 4)} AS MAE, {rounded(f'avg(abs(pred_price - y_price) / greatest(abs(y_price), {EPS}))', 4)} AS MAPE,
        CASE WHEN grouping(goods_id) = 1 THEN 'all' WHEN grouping(wh_dept_id) = 1 THEN 'goods' ELSE 'wh_goods' END AS grain
      FROM {source} GROUP BY GROUPING SETS ((dt, model), (dt, model, goods_id), (dt, model, wh_dept_id, goods_id))) {where}"""


GRAINS = {"all": [], "goods": ["goods_id"], "wh_goods": ["wh_dept_id", "goods_id"]}
VIEWS = "evaluated unit_price"


def evaluated_totals(inp: Inputs) -> DataFrame:
    return acc.horizon_totals(inp.evaluated, ["model", "dt", *KEYS], "y", "predict_demand")


@query("accuracy_metrics", sql(VIEWS, metric_sql('daily_money'), **MONEY))
def accuracy_metrics(inp: Inputs) -> DataFrame:
    money = acc.to_money(inp.evaluated, inp.unit_price, "y", "predict_demand")
    return acc.accuracy_metrics(money, ["dt", "model"], GRAINS, "y_price", "pred_price")


@query("money_conversion", sql(VIEWS, "SELECT model, dt, predict_dt, wh_dept_id, goods_id, y_price, pred_price FROM daily_money", **MONEY))
def money_conversion(inp: Inputs) -> DataFrame:
    money = acc.to_money(inp.evaluated, inp.unit_price, "y", "predict_demand")
    return money.select("model", "dt", "predict_dt", *KEYS, "y_price", "pred_price")


@query(
    "eval_daily_vs_month",
    sql(VIEWS, f"""SELECT 'daily' AS time_label, * FROM ({metric_sql('daily_money')})
      UNION ALL SELECT 'month', * FROM ({metric_sql('month_money')})""", **MONEY),
)
def eval_daily_vs_month(inp: Inputs) -> DataFrame:
    """The same forecasts judged day by day and by the sum over their horizon."""
    parts = []
    for label, df in (("daily", inp.evaluated), ("month", evaluated_totals(inp))):
        money = acc.to_money(df, inp.unit_price, "y", "predict_demand")
        metrics = acc.accuracy_metrics(money, ["dt", "model"], GRAINS, "y_price", "pred_price")
        parts.append(metrics.withColumn("time_label", F.lit(label)))
    return parts[0].unionByName(parts[1])


@query(
    "backtest_grains",
    sql("evaluated", f"""SELECT model, dt, wh_dept_id, goods_id, grain, demand, theory_sale_cnt, {rounded('mape', 6)} AS MAPE, {rounded('abs(demand - theory_sale_cnt)', 4)} AS MAE,
        {rounded('(demand - theory_sale_cnt) * (demand - theory_sale_cnt)', 2)} AS MSE, {rounded('CASE WHEN mape > 1 THEN 0 ELSE 1 - mape END', 6)} AS ACC FROM (
      SELECT *, abs((demand - theory_sale_cnt) / nullif(theory_sale_cnt, 0)) AS mape FROM (
        SELECT f.model, f.dt, f.wh_dept_id, f.goods_id, CASE WHEN grouping(f.goods_id) = 1 THEN 'country' WHEN grouping(f.wh_dept_id) = 1 THEN 'goods' ELSE 'wh_goods' END AS grain,
          {rounded('sum(f.predict_demand)', 1)} AS demand, coalesce(sum(d.y), 0) AS theory_sale_cnt
        FROM forecast f LEFT JOIN daily_demand d ON f.predict_dt = d.ds AND f.wh_dept_id = d.wh_dept_id AND f.goods_id = d.goods_id
        GROUP BY GROUPING SETS ((f.model, f.dt, f.wh_dept_id, f.goods_id), (f.model, f.dt, f.goods_id), (f.model, f.dt))))"""),
)
def backtest_grains(inp: Inputs) -> DataFrame:
    actual = inp.actual.select(F.col("ds").alias("predict_dt"), *KEYS, F.col("y").alias("theory_sale_cnt"))
    merged = inp.forecast_by_day.join(actual, ["predict_dt", *KEYS], "left")
    grains = {"wh_goods": KEYS, "goods": ["goods_id"], "country": []}
    measures = [half_even(F.sum("predict_demand"), 1).alias("demand"), F.coalesce(F.sum("theory_sale_cnt"), F.lit(0.0)).alias("theory_sale_cnt")]
    return acc.backtest_errors(agg.multi_grain(merged, ["model", "dt"], grains, measures), "theory_sale_cnt", "demand")


MONTHLY = {**MONEY, "monthly": metric_sql("month_money", "wh_goods")}


def monthly_metrics(inp: Inputs) -> DataFrame:
    """Monthly metrics per model, warehouse and goods."""
    money = acc.to_money(evaluated_totals(inp), inp.unit_price, "y", "predict_demand")
    return acc.accuracy_metrics(money, ["dt", "model"], {"wh_goods": KEYS}, "y_price", "pred_price").drop("grain")


def recent_sql(months: tuple[int, ...], keys: str = "model, wh_dept_id, goods_id", source: str = "monthly") -> str:
    columns = []
    for n in months:
        over = f"OVER (PARTITION BY {keys} ORDER BY dt ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        columns += [f"(round_even(avg(round_even({m} * 1e4, 0)) {over}, 0) + 0e0) / 1e4 AS last_{n}_{m.lower()}" for m in ("MSE", "MAE", "MAPE", "ACC")]
        columns.append(f"(round_even(stddev_samp(round_even(ACC * 1e4, 0)) {over}, 0) + 0e0) / 1e4 AS last_{n}_std")
    return f"SELECT {keys}, dt, {', '.join(columns)} FROM {source}"


RECENT = (1, 2, 3, 6)


@query(
    "recent_acc_mean",
    sql(VIEWS, f"SELECT 'wh_goods' AS level, * FROM ({recent_sql(RECENT)}) UNION ALL SELECT 'goods', model, NULL, goods_id, dt, COLUMNS('last_.*') FROM ({recent_sql(RECENT, 'model, goods_id', 'by_goods')})",
        **MONTHLY, by_goods=metric_sql("month_money", "goods")),
)
def recent_acc_mean(inp: Inputs) -> DataFrame:
    """Recent accuracy per warehouse and goods, and per goods."""
    kept = [f"last_{n}_{m}" for n in RECENT for m in ("mse", "mae", "mape", "acc", "std")]
    money = acc.to_money(evaluated_totals(inp), inp.unit_price, "y", "predict_demand")
    parts = []
    for level, grain in (("wh_goods", KEYS), ("goods", ["goods_id"])):
        metrics = acc.accuracy_metrics(money, ["dt", "model"], {level: grain}, "y_price", "pred_price")
        recent = acc.recent_accuracy(metrics, ["model", *grain], "dt", RECENT)
        parts.append(recent.select(F.lit(level).alias("level"), "model", *grain, "dt", *kept))
    return parts[0].unionByName(parts[1], allowMissingColumns=True)


def recent(inp: Inputs, n: int) -> DataFrame:
    return acc.recent_accuracy(monthly_metrics(inp), ["model", *KEYS], "dt", [n])


NEWEST = "SELECT *, row_number() OVER (PARTITION BY model, wh_dept_id, goods_id ORDER BY dt DESC) AS newest FROM ({})"


@query(
    "best_model",
    sql(VIEWS, """SELECT wh_dept_id, goods_id, model, last_1_acc FROM (
      SELECT *, rank() OVER (PARTITION BY wh_dept_id, goods_id ORDER BY last_1_acc DESC) AS place FROM recent WHERE newest = 1) WHERE place = 1""",
        **MONTHLY, recent=NEWEST.format(recent_sql((1,)))),
)
def best_model(inp: Inputs) -> DataFrame:
    return sel.latest_best_model(recent(inp, 1), KEYS, "dt", "last_1_acc", ties="all")


@query(
    "mix_forecast",
    sql(VIEWS, """SELECT f.wh_dept_id, f.goods_id, f.model, f.dt, f.predict_dt, f.predict_demand FROM forecast f JOIN (
      SELECT *, row_number() OVER (PARTITION BY wh_dept_id, goods_id ORDER BY last_1_acc DESC, model) AS place FROM recent WHERE newest = 1) b
      ON f.wh_dept_id = b.wh_dept_id AND f.goods_id = b.goods_id AND f.model = b.model WHERE place = 1""",
        **MONTHLY, recent=NEWEST.format(recent_sql((1,)))),
)
def mix_forecast(inp: Inputs) -> DataFrame:
    best = sel.latest_best_model(recent(inp, 1), KEYS, "dt", "last_1_acc")
    return sel.mixed_forecast(inp.forecast, best, KEYS).select(*KEYS, "model", "dt", "predict_dt", "predict_demand")


@query(
    "best_model_prev_month",
    sql(VIEWS, """SELECT wh_dept_id, goods_id, dt, last_3_acc, lag(model) OVER (PARTITION BY wh_dept_id, goods_id ORDER BY dt) AS best_model FROM (
      SELECT *, row_number() OVER (PARTITION BY wh_dept_id, goods_id, dt ORDER BY last_3_acc DESC, model) AS place FROM recent) WHERE place = 1""",
        **MONTHLY, recent=recent_sql((3,))),
)
def best_model_prev_month(inp: Inputs) -> DataFrame:
    return sel.previous_best_model(recent(inp, 3), KEYS, "dt", "last_3_acc")


POPULATIONS = """SELECT 'all' AS data_label, wh_dept_id, goods_id, ds, sum(qty) AS y FROM sold_rows GROUP BY 2, 3, 4
  UNION ALL SELECT CASE shop_type_flg WHEN 'norm_shop' THEN 'normal' ELSE 'new_shop_normal' END, wh_dept_id, goods_id, ds, sum(qty)
  FROM sold_rows WHERE type_flg = 'norm' GROUP BY 1, 2, 3, 4"""


@query(
    "combine_populations",
    sql("sold_rows", f"""SELECT 'normal' AS kind, predict_dt, wh_dept_id, goods_id, {rounded('sum(predict_demand)', 1)} AS demand FROM pred WHERE data_label <> 'all' GROUP BY 2, 3, 4
      UNION ALL SELECT 'all', predict_dt, wh_dept_id, goods_id, {rounded('max(predict_demand)', 1)} FROM pred WHERE data_label = 'all' GROUP BY 2, 3, 4""",
        populations=POPULATIONS,
        pred=f"""SELECT data_label, wh_dept_id, goods_id, CAST(ds + CAST(h AS INTEGER) AS DATE) AS predict_dt, {rounded('m7', 1)} AS predict_demand FROM (
          SELECT *, avg(y) OVER (PARTITION BY data_label, wh_dept_id, goods_id ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS m7 FROM ({dense_sql('populations', 'data_label, wh_dept_id, goods_id')})), range(0, 30) r(h)
          WHERE day(ds) = 1 AND m7 IS NOT NULL"""),
)
def combine_populations(inp: Inputs) -> DataFrame:
    """Forecasts of three populations; the horizons overlap around month ends, as the groups do."""
    keys = ["data_label", *KEYS]
    demand = staged(series.daily_sum(series.with_populations(inp.sold_by_day), keys, "ds", "qty"), "population-daily")
    demand = series.dense_from_first(demand, keys, "ds", "y")
    pred = fc.flat_baselines(win.trailing_means(demand, keys, "ds", "y", (7,)), keys, "ds", (7,), 30)
    pred = pred.withColumn("predict_demand", half_even(F.col("predict_demand"), 1))
    return sel.combine_populations(pred, ["predict_dt", *KEYS], "predict_demand")


@query(
    "weighted_ensemble",
    sql(VIEWS, f"""SELECT f.wh_dept_id, f.goods_id, f.predict_dt, {rounded('sum(f.predict_demand * coalesce(w.last_3_acc / nullif(w.total, 0), 0))', 4)} AS predict_demand
      FROM (SELECT * FROM forecast WHERE dt = (SELECT max(dt) FROM forecast)) f LEFT JOIN (SELECT *, sum(last_3_acc) OVER (PARTITION BY wh_dept_id, goods_id) AS total FROM recent WHERE newest = 1) w
      ON f.wh_dept_id = w.wh_dept_id AND f.goods_id = w.goods_id AND f.model = w.model GROUP BY 1, 2, 3""",
        **MONTHLY, recent=NEWEST.format(recent_sql((3,)))),
)
def weighted_ensemble(inp: Inputs) -> DataFrame:
    weights = win.last_rows(recent(inp, 3), ["model", *KEYS], "dt")
    newest = win.newest_slice(inp.forecast, "dt")
    mixed = sel.weighted_ensemble(newest, weights, KEYS, "last_3_acc", "predict_demand")
    return mixed.withColumn("predict_demand", half_even(F.col("predict_demand"), 4))


# --- accuracy marts -------------------------------------------------------------------------

GOODS = """SELECT goods_id, 'goods_' || CAST(goods_id AS VARCHAR) AS goods_name, CAST(goods_id % 4 AS BIGINT) AS large_class_id,
  'class_' || CAST(goods_id % 4 AS VARCHAR) AS large_class_name FROM (SELECT DISTINCT CAST(p_size % 8 + 8 * (p_partkey // 10000) AS BIGINT) AS goods_id FROM part)"""


def goods_dim(inp: Inputs) -> DataFrame:
    goods = goods_number()
    return inp.table("part").select(
        goods.cast("long").alias("goods_id"),
        F.concat(F.lit("goods_"), goods.cast("string")).alias("goods_name"),
        (goods % 4).cast("long").alias("large_class_id"),
        F.concat(F.lit("class_"), (goods % 4).cast("string")).alias("large_class_name"),
    ).distinct()


WAREHOUSES = "SELECT CAST(n_nationkey AS BIGINT) AS wh_dept_id, n_name AS wh_name FROM nation"


def warehouse_dim(inp: Inputs) -> DataFrame:
    return inp.table("nation").select(F.col("n_nationkey").cast("long").alias("wh_dept_id"), F.col("n_name").alias("wh_name"))


@query(
    "actual_consumption",
    sql("sold_rows", """SELECT wh_dept_id, s.goods_id, large_class_name, sum(qty) AS real_consume FROM (SELECT wh_dept_id, goods_id, ds, qty FROM sold_rows) s JOIN goods g ON s.goods_id = g.goods_id
        WHERE ds BETWEEN DATE '1999-01-01' AND DATE '1999-06-30' AND large_class_id IN (0, 1) GROUP BY 1, 2, 3
      UNION ALL SELECT wh_dept_id, s.goods_id, large_class_name, sum(qty) FROM (SELECT wh_dept_id, goods_id, ds, qty, l_returnflag FROM sold_rows) s JOIN goods g ON s.goods_id = g.goods_id
        WHERE ds BETWEEN DATE '1999-01-01' AND DATE '1999-06-30' AND l_returnflag <> 'R' AND large_class_id IN (2, 3) GROUP BY 1, 2, 3""", goods=GOODS),
)
def actual_consumption(inp: Inputs) -> DataFrame:
    """Consumption for two classes, delivered rows for the other two."""
    goods = goods_dim(inp)
    rows = inp.sold_rows.drop("large_class_name")
    sources = [
        (rows, goods.where(F.col("large_class_id").isin(0, 1))),
        (rows.where(F.col("l_returnflag") != "R"), goods.where(F.col("large_class_id").isin(2, 3))),
    ]
    mart = acc.consumption_mart(sources, KEYS, "qty", "1999-01-01", "1999-06-30")
    return mart.select("wh_dept_id", "goods_id", "large_class_name", "real_consume")


@query(
    "lifecycle_class",
    sql("", """SELECT wh_dept_id, cmdty_id, make_timestamp(CAST(a * 1000000 AS BIGINT)) AS launch_date, make_timestamp(CAST(b * 1000000 AS BIGINT)) AS sale_date,
        make_timestamp(CAST(c * 1000000 AS BIGINT)) AS actual_launch_date,
        CASE WHEN (b > run - 21 * 86400 AND b <= run) OR (c > run - 21 * 86400 AND c <= run) THEN 'subnew' WHEN a > run AND b IS NULL THEN 'new' ELSE 'norm' END AS cmdty_type
      FROM (SELECT l_suppkey % 5 AS wh_dept_id, l_partkey AS cmdty_id, median(epoch(CAST(o_orderdate AS DATE))) AS a,
              median(CASE WHEN l_returnflag = 'A' THEN epoch(CAST(l_shipdate AS DATE)) END) AS b, median(epoch(CAST(l_shipdate AS DATE) + l_linenumber)) AS c,
              epoch(DATE '1998-04-15') AS run
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""),
)
def lifecycle_class(inp: Inputs) -> DataFrame:
    line, orders = inp.table("lineitem"), inp.table("orders")
    ship = F.to_date("l_shipdate")
    plan = line.join(orders, line.l_orderkey == orders.o_orderkey).select(
        (F.col("l_suppkey") % 5).alias("wh_dept_id"),
        F.col("l_partkey").alias("cmdty_id"),
        F.to_date("o_orderdate").alias("launch_date"),
        F.when(F.col("l_returnflag") == "A", ship).alias("sale_date"),
        F.date_add(ship, F.col("l_linenumber")).alias("actual_launch_date"),
    )
    return acc.lifecycle_class(plan, ["wh_dept_id", "cmdty_id"], "1998-04-15")


RUN_DAY = "2000-06-15"
LENGTHS = (14, 30, 60)


def fact_parts(lengths: tuple[int, ...]) -> dict[str, str]:
    """Named parts of the accuracy fact over trailing windows."""
    flat = """SELECT {kind} AS kind, wh_dept_id, goods_id, ds AS dt, CAST(ds + CAST(h AS INTEGER) AS DATE) AS predict_dt, m7 AS demand FROM (
        SELECT *, avg(y) OVER (PARTITION BY wh_dept_id, goods_id ORDER BY ds ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS m7
        FROM ({dense})), range(0, 61) r(h)
        WHERE m7 IS NOT NULL AND ds IN (SELECT run_dt FROM spans)"""
    amount = {k: rounded(f"{v} * unit_price", 2) for k, v in (("ac", "real_consume"), ("cc", "common_consume"), ("cp", "common_pred"), ("ap", "all_pred"))}
    return {
        "goods": GOODS,
        "spans": f"""SELECT days, CAST(DATE '{RUN_DAY}' - days AS DATE) AS start, DATE '{RUN_DAY}' - 1 AS "end", CAST(DATE '{RUN_DAY}' - days - 1 AS DATE) AS run_dt
          FROM (SELECT unnest([{', '.join(f'{n}::INTEGER' for n in lengths)}]) AS days)""",
        "sums_all": "SELECT wh_dept_id, goods_id, ds, sum(qty) AS y FROM sold_rows GROUP BY 1, 2, 3",
        "sums_common": "SELECT wh_dept_id, goods_id, ds, sum(qty) AS y FROM sold_rows WHERE type_flg = 'norm' GROUP BY 1, 2, 3",
        "preds": " UNION ALL ".join(flat.format(kind=f"'{k}'", dense=dense_sql(f"sums_{k}", "wh_dept_id, goods_id")) for k in ("all", "common")),
        "predicted": """SELECT days, run_dt, wh_dept_id, goods_id, round_even(sum(demand) FILTER (WHERE kind = 'all') * 1e4, 0) / 1e4 AS all_pred,
            round_even(sum(demand) FILTER (WHERE kind = 'common') * 1e4, 0) / 1e4 AS common_pred
          FROM preds JOIN spans ON dt = run_dt AND predict_dt BETWEEN start AND "end" GROUP BY 1, 2, 3, 4""",
        "consumed": f"""SELECT days, run_dt, wh_dept_id, goods_id, sum(qty) AS real_consume,
            coalesce({rounded("sum(qty) FILTER (WHERE type_flg = 'norm') / nullif(sum(qty), 0)", 2)}, NULL) AS common_ratio
          FROM sold_rows JOIN spans ON ds BETWEEN start AND "end" GROUP BY 1, 2, 3, 4""",
        "priced": f"SELECT wh_dept_id, goods_id, {rounded('unit_price', 4)} AS unit_price FROM unit_price",
        "slow": """SELECT goods_id FROM (SELECT DISTINCT wh_dept_id, goods_id FROM sold_rows) WHERE (wh_dept_id + goods_id) % 3 IN (0, 1) GROUP BY 1 HAVING count(*) > 3""",
        "fact": f"""SELECT *, cp - cc AS diff_common, ap - ac AS diff_all, {rounded('(common_pred - common_consume) / nullif(common_consume, 0)', 2)} AS MPE_common,
            {rounded('(ap - ac) / nullif(ac, 0)', 2)} AS MPE_all FROM (
          SELECT *, {amount['ac']} AS ac, {amount['cc']} AS cc, {amount['cp']} AS cp, {amount['ap']} AS ap FROM (
            SELECT *, {rounded('real_consume * common_ratio', 2)} AS common_consume FROM (
              SELECT p.days, p.run_dt, p.wh_dept_id, p.goods_id, coalesce(p.all_pred, 0) AS all_pred, coalesce(p.common_pred, 0) AS common_pred, c.real_consume,
                u.unit_price, g.goods_name, g.large_class_name,
                coalesce(CASE WHEN p.all_pred > 0 AND coalesce(p.common_pred, 0) = 0 THEN 0 ELSE c.common_ratio END, 1) AS common_ratio,
                CAST(s.goods_id IS NOT NULL AS BIGINT) AS is_longtail
              FROM predicted p JOIN consumed c ON p.days = c.days AND p.wh_dept_id = c.wh_dept_id AND p.goods_id = c.goods_id
              LEFT JOIN priced u ON p.wh_dept_id = u.wh_dept_id AND p.goods_id = u.goods_id LEFT JOIN goods g ON p.goods_id = g.goods_id
              LEFT JOIN slow s ON p.goods_id = s.goods_id)))""",
    }


def slow_classes(sold: DataFrame) -> DataFrame:
    """Delivery class of every warehouse and goods."""
    kind = (F.col("wh_dept_id") + F.col("goods_id")) % 3
    label = F.when(kind == 0, "f90").when(kind == 1, "f180").otherwise("fast")
    return sold.select(*KEYS).distinct().withColumn("dly_model_type", label)


def fact(inp: Inputs, lengths: tuple[int, ...]) -> DataFrame:
    spans = acc.spans_of(RUN_DAY, lengths)
    group = ["days", "run_dt", *KEYS]
    norm = F.col("type_flg") == "norm"
    # The sold rows are read once; everything below works on their daily sums.
    daily = inp.sold_by_day.groupBy(*KEYS, "ds", "type_flg").agg(F.sum("qty").alias("qty"), F.sum("money").alias("money"))
    sold = staged(daily, "sold-daily")
    parts = []
    for kind, rows in (("all_pred", sold), ("common_pred", sold.where(norm))):
        summed = staged(series.daily_sum(rows, KEYS, "ds", "qty"), "sold-sums")
        dense = series.dense_from_first(summed, KEYS, "ds", "y")
        feats = win.trailing_means(dense, KEYS, "ds", "y", (7,))
        flat = fc.flat_baselines(feats, KEYS, "ds", (7,), 61, origin=F.col("ds").isin([s.run_dt for s in spans]))
        summed = acc.in_spans(flat, "predict_dt", spans, "dt").groupBy(*group)
        parts.append(summed.agg(half_even(F.sum("predict_demand"), 4).alias(kind)))
    predicted = parts[0].join(parts[1], group, "left")
    consumed = acc.in_spans(sold, "ds", spans).groupBy(*group).agg(
        F.sum("qty").alias("real_consume"), F.sum(F.when(norm, F.col("qty"))).alias("_norm")
    )
    ratio = half_even(F.try_divide(F.col("_norm"), F.col("real_consume")), 2)
    price = priced(sold).withColumn("unit_price", half_even(F.col("unit_price"), 4))
    slow = acc.slow_goods(slow_classes(sold), ["f90", "f180", "f365"], 3)
    return acc.accuracy_fact(
        predicted, consumed.drop("_norm"), consumed.select(*group, ratio.alias("common_ratio")), price, goods_dim(inp), slow, ["days", "run_dt"]
    )


@query(
    "accuracy_fact",
    sql("sold_rows unit_price", f"""SELECT days, run_dt, wh_dept_id, goods_id, goods_name, large_class_name, is_longtail, all_pred, common_pred, real_consume, common_ratio, common_consume,
        ac AS all_consume_amount, cc AS common_consume_amount, cp AS common_predict_amount, ap AS all_predict_amount, {rounded('diff_common', 2)} AS diff_common,
        {rounded('diff_all', 2)} AS diff_all, MPE_common, MPE_all, abs(MPE_all) AS MAPE_all FROM fact""", **fact_parts((30,))),
)
def accuracy_fact(inp: Inputs) -> DataFrame:
    return fact(inp, (30,)).select(
        "days", "run_dt", *KEYS, "goods_name", "large_class_name", "is_longtail", "all_pred", "common_pred", "real_consume", "common_ratio", "common_consume",
        "all_consume_amount", "common_consume_amount", "common_predict_amount", "all_predict_amount", half_even(F.col("diff_common"), 2).alias("diff_common"),
        half_even(F.col("diff_all"), 2).alias("diff_all"), "MPE_common", "MPE_all", "MAPE_all",
    )


@query(
    "longtail_flag",
    sql("sold_rows", """SELECT k.wh_dept_id, k.goods_id, CAST(s.goods_id IS NOT NULL AS BIGINT) AS is_longtail FROM (SELECT DISTINCT wh_dept_id, goods_id FROM sold_rows) k
      LEFT JOIN (SELECT goods_id FROM (SELECT DISTINCT wh_dept_id, goods_id FROM sold_rows) WHERE (wh_dept_id + goods_id) % 3 IN (0, 1) GROUP BY 1 HAVING count(*) > 3) s
      ON k.goods_id = s.goods_id"""),
)
def longtail_flag(inp: Inputs) -> DataFrame:
    classes = slow_classes(inp.sold_rows)
    slow = acc.slow_goods(classes, ["f90", "f180", "f365"], 3).select("goods_id", F.lit(1).cast("long").alias("is_longtail"))
    return classes.select(*KEYS).join(slow, "goods_id", "left").na.fill(0, ["is_longtail"])


def grain_sql(where: str = "true") -> str:
    columns = ["CAST(median(is_longtail) > 0.5 AS BIGINT) AS is_longtail"]
    for suffix, keep in (("", "true"), ("_nolongtail", "is_longtail = 0")):
        for k, c in (("common", "cc"), ("all", "ac")):
            f = f"FILTER (WHERE {keep})"
            diff = f"diff_{k}"
            whole = f"CAST(round_even({diff} * 100, 0) AS HUGEINT)"
            squares = f"(CAST(sum({whole} * {whole}) {f} AS DOUBLE) / 1e4)"

            def cents(value: str, f: str = f) -> str:
                return f"(sum(round_even({value} * 100, 0)) {f} / 100)"

            columns += [
                f"{rounded(f'coalesce(CASE WHEN {cents(c)} > 0 THEN {cents(f'abs({diff})')} / {cents(c)} END, 0)', 6)} AS mape_{k}{suffix}",
                f"{rounded(f'{squares} / count(*) {f}', 4)} AS mse_{k}{suffix}",
                f"{rounded(f'sqrt({squares} / count(*) {f})', 3)} AS rmse_{k}{suffix}",
                f"{rounded(cents(f'abs({diff})') + f' / count(*) {f}', 3)} AS mae_{k}{suffix}",
            ]
    return f"""SELECT days, run_dt, large_class_name, goods_id,
      CASE WHEN grouping(large_class_name) = 1 THEN 'all' WHEN grouping(goods_id) = 1 THEN 'class' ELSE 'goods' END AS grain, {', '.join(columns)}
      FROM fact WHERE unit_price IS NOT NULL AND {where} GROUP BY GROUPING SETS ((days, run_dt, large_class_name, goods_id), (days, run_dt, large_class_name), (days, run_dt))"""


@query("accuracy_by_grain", sql("sold_rows unit_price", grain_sql("large_class_name <> 'class_3'"), **fact_parts((30,))))
def accuracy_by_grain(inp: Inputs) -> DataFrame:
    """One class is left out."""
    return acc.accuracy_by_grain(fact(inp, (30,)), ["days", "run_dt"], ["class_3"])


@query("accuracy_windows", sql("sold_rows unit_price", grain_sql(), **fact_parts(LENGTHS)))
def accuracy_windows(inp: Inputs) -> DataFrame:
    """All three trailing windows in one job."""
    return acc.accuracy_by_grain(fact(inp, LENGTHS), ["days", "run_dt"])


MONTH_ERRORS = {
    "goods": GOODS,
    "warehouses": WAREHOUSES,
    "totals": f"""SELECT model, dt, wh_dept_id, goods_id, {rounded('sum(y)', 1)} AS y, {rounded('sum(predict_demand)', 1)} AS pred FROM evaluated GROUP BY 1, 2, 3, 4""",
    "errors": f"""SELECT t.*, CAST(month(dt) AS INTEGER) AS month, {rounded('abs(pred - y) / nullif(y, 0)', 2)} AS err, w.wh_name, g.goods_name, g.large_class_name
      FROM totals t JOIN goods g ON t.goods_id = g.goods_id JOIN warehouses w ON t.wh_dept_id = w.wh_dept_id WHERE model = 'window_28'""",
}


def month_errors(inp: Inputs) -> DataFrame:
    """Monthly relative error per warehouse and goods with names."""
    totals = evaluated_totals(inp).where(F.col("model") == "window_28").withColumnRenamed("predict_demand", "pred")
    err = half_even(F.abs(F.try_divide(F.col("pred") - F.col("y"), F.col("y"))), 2)
    named = totals.withColumns({"month": F.month("dt"), "err": err})
    return named.join(goods_dim(inp), "goods_id").join(warehouse_dim(inp), "wh_dept_id")


@query(
    "monthly_bands",
    sql("evaluated", f"""SELECT *, {BAND_RATIOS} FROM (
      SELECT month, wh_name, large_class_name, goods_name, CASE WHEN grouping(wh_name) = 0 THEN 'wh' WHEN grouping(large_class_name) = 0 THEN 'class'
        WHEN grouping(goods_name) = 0 THEN 'goods' ELSE 'month' END AS grain, count(*) AS total, {BAND_COUNTS}
      FROM (SELECT *, {BAND_CASE} AS band FROM errors) GROUP BY GROUPING SETS ((month), (month, wh_name), (month, large_class_name), (month, goods_name)))""", **MONTH_ERRORS),
)
def monthly_bands(inp: Inputs) -> DataFrame:
    grains = {"month": [], "wh": ["wh_name"], "class": ["large_class_name"], "goods": ["goods_name"]}
    return agg.band_ratios(month_errors(inp), ["month"], grains, F.col("err"))


@query(
    "bad_cases",
    sql("evaluated", f"""SELECT dt, wh_name || '_' || goods_name AS wh_goods, {BAND_CASE} AS accuracy_label, err AS "MAPE_all", pred, y, {rounded('pred - y', 1)} AS diff
      FROM errors JOIN (SELECT goods_id AS top_goods FROM (SELECT goods_id, sum(money) AS income FROM sold_rows GROUP BY 1) ORDER BY income DESC, goods_id LIMIT 20)
      ON goods_id = top_goods WHERE err > 0.4""", **MONTH_ERRORS),
)
def bad_cases(inp: Inputs) -> DataFrame:
    """Errors above 0.4 of the 20 goods with the highest income, sorted for the report."""
    income = inp.sold_rows.groupBy("goods_id").agg(F.sum("money").alias("income"))
    top = income.orderBy(F.desc("income"), "goods_id").limit(20).select("goods_id")
    bad = acc.bad_cases(month_errors(inp).join(top, "goods_id", "left_semi"), "err", 0.4)
    return bad.select("dt", "wh_goods", "accuracy_label", F.col("err").alias("MAPE_all"), "pred", "y", "diff").orderBy("accuracy_label", "MAPE_all")
