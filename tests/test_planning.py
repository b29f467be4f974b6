"""Ordered and allocating operators against plain loops over the written rules."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from stockwise.operators import forecast as fc
from stockwise.operators import learning as ml
from stockwise.operators import quality, series
from stockwise.operators import replenish as rep

DAY = dt.date(2024, 1, 1)


def days(n):
    return DAY + dt.timedelta(days=n)


def to_box(q, box):
    if 0 < q < box:
        q = box
    return round(q / box) * box


def allocate(orders, stock, box):
    """Round-robin of single boxes, largest order first, until the stock is gone."""
    if stock >= sum(orders.values()):
        return dict(orders)
    granted = dict.fromkeys(orders, 0.0)
    line = sorted(orders, key=lambda s: (-orders[s], s))
    while stock > 0 and any(granted[s] < orders[s] for s in line):
        for s in line:
            if stock <= 0:
                break
            step = min(box, orders[s] - granted[s])
            granted[s] += step
            stock -= step
    return granted


# Ids of stores: near each other, spread over all 64-bit numbers, and texts of which some begin others.
STORE_IDS = {
    "small": (lambda k: k, "long"),
    "hashed": (lambda k: (k * 0x9E3779B97F4A7C15 + 77) % (1 << 64) - (1 << 63), "long"),
    "text": (lambda k: "s" * (k % 4) + format(k * k, "x") + "ä" * (k % 3), "string"),
}


@pytest.mark.parametrize("ids", STORE_IDS)
def test_shortage_allocation(spark, ids):
    rnd = random.Random(7)
    name, kind = STORE_IDS[ids]
    rows, expected = [], {}
    for group in range(25):
        # One group holds a third of all stores, most of them with the same order size.
        size = 160 if group == 0 else rnd.randint(1, 14)
        box = float(rnd.choice([5, 10]))
        choices = [30.0] if group == 0 else [0.0, 7.0, 10.0, 20.0, 25.0, 40.0]
        orders = {name(s): rnd.choice(choices) for s in rnd.sample(range(1000), size)}
        total = sum(orders.values())
        stock = rnd.choice([0.0, -5.0, total, total + 3, math.floor(total * 0.6), math.floor(total * 0.13)])
        if group == 0:
            stock = 160 * box + 37 * box
        rows += [(group, s, q, float(stock), box) for s, q in orders.items()]
        expected |= {(group, s): g for s, g in allocate(orders, stock, box).items()}
    df = spark.createDataFrame(rows, f"g int, dept {kind}, qty double, stock double, box double")
    out = rep.shortage_allocation(df, ["g"], "dept", "qty", "stock", "box")
    assert {(r["g"], r["dept"]): r["resign"] for r in out.collect()} == expected


@pytest.mark.parametrize("digits", [1, 3])
def test_nth_smallest(spark, digits):
    rnd = random.Random(digits)
    groups = {g: [rnd.randrange(-(1 << 63), 1 << 63) for _ in range(40 + g)] if g % 2 else [5 * k - 90 for k in range(40 + g)] for g in range(6)}
    rows = [(g, k, 1 + 7 * g) for g, keys in groups.items() for k in keys]
    df = spark.createDataFrame(rows, "g int, id long, place int")
    keyed = df.select("g", "id", "place", rep.sort_key(df, "id").alias("key"))
    until = rep.nth_smallest(keyed, ["g"], "key", "place", digits)
    found = keyed.join(until, "g").where(F.substring("key", F.lit(1), F.length("_until")) <= F.col("_until"))
    got = {g: set() for g in groups}
    for r in found.collect():
        got[r["g"]].add(r["id"])
    assert got == {g: set(sorted(keys)[: 1 + 7 * g]) for g, keys in groups.items()}


def plan_rows(rnd, keys, n):
    rows = []
    for k in range(keys):
        box, opening = float(rnd.choice([1, 5, 12])), float(rnd.randint(0, 40))
        for d in range(n):
            rows.append((
                k, days(d), float(rnd.randint(0, 15)), float(rnd.randint(0, 5)), float(rnd.randint(0, 40)), float(rnd.randint(0, 25)),
                box, rnd.randint(0, 1), days(d + rnd.randint(-1, 6)), opening, float(rnd.choice([0, 0, 0, 10, 25])),
            ))
    return rows


PLAN = "k int, dt date, pred_consume double, ss_ro double, bp_consume double, vlt_consume double, dly_use_ratio double, can_order int, receive_day date, shop_beg double, expected_receive double"


def test_stock_rollforward(spark):
    rows = plan_rows(random.Random(1), 12, 40)
    df = spark.createDataFrame(rows, PLAN)
    out = rep.stock_rollforward(df, ["k"], "dt", "shop_beg", "expected_receive", "pred_consume")
    got = {(r["k"], r["dt"]): (r["stock_beg"], r["stock_end"]) for r in out.collect()}
    stock, expected = {}, {}
    for r in sorted(rows):
        begin = stock.get(r[0], r[9])
        stock[r[0]] = max(0.0, begin + r[10] - r[2])
        expected[r[0], r[1]] = (begin, stock[r[0]])
    assert got == expected


def test_reorder_plan(spark):
    rows = plan_rows(random.Random(2), 15, 45)
    out = rep.reorder_plan(spark.createDataFrame(rows, PLAN), ["k"]).collect()
    got = {(r["k"], r["dt"]): (r["receive_day"], r["order_num"]) for r in out}
    expected = {}
    for key in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == key)
        ledger = [(r[1], r[10]) for r in mine if r[10] > 0]
        stock = mine[0][9]
        for _, day, consume, ss, bp, vlt, box, can, receive, _, _ in mine:
            arrived = sum(q for d, q in ledger if d == day)
            pending = sum(q for d, q in ledger if d > day)
            if can == 1:
                projected = max(0.0, stock + arrived + pending - vlt)
                order = to_box(max(0.0, max(0.0, bp + ss) - projected), box)
                expected[key, day] = (receive, order)
                ledger.append((receive, order))
            stock = max(0.0, stock + arrived - consume)
    assert got == expected


def test_calloff_plan(spark):
    rnd = random.Random(3)
    rows = []
    for k in range(10):
        lt, bp, po = rnd.choice([0, 1, 3, 60]), rnd.randint(1, 4), float(rnd.choice([0, 50, 500, 5000]))
        for d in range(30):
            rows.append((k, days(d), float(rnd.randint(0, 30)), lt, bp, 2.0, float(rnd.randint(0, 80)), float(rnd.choice([0, 0, 20])), po, 12.0))
    schema = "k int, dt date, theory_order_sum double, lt_cg long, bp_cg long, ss_cg double, beg_wh_stock double, transit double, po_remain double, pur_use_ratio double"
    out = rep.calloff_plan(spark.createDataFrame(rows, schema), ["k"]).collect()
    got = sorted((r["k"], r["dt"], r["transit"]) for r in out)
    expected = []
    for key in range(10):
        mine = sorted(r for r in rows if r[0] == key)
        demand = [r[2] for r in mine]
        lt, bp, po, unit = mine[0][3], mine[0][4], mine[0][8], mine[0][9]

        def ahead(i, n):
            return sum(demand[i:i + n]) if n > 0 and i + n <= len(demand) else 0.0

        ledger = {}
        ledger[mine[0][1]] = max(r[6] for r in mine)
        for r in mine:
            if r[7] > 0:
                ledger[r[1]] = ledger.get(r[1], 0.0) + r[7]
        ledger = list(ledger.items())
        stock = 0.0
        for i, r in enumerate(mine):
            arrived = sum(q for d, q in ledger if d == r[1])
            pending = sum(q for d, q in ledger if d > r[1])
            lead, cover = ahead(i, lt), ahead(i, lt + bp)
            safety = cover / (lt + bp) * r[5]
            projected = max(0.0, stock + arrived + pending - lead)
            need = max(0.0, cover - lead + safety)
            wanted = math.ceil(max(0.0, need - projected) / unit) * unit
            buy = min(wanted, po)
            po = max(0.0, po - wanted)
            if buy > 0:
                ledger.append((r[1] + dt.timedelta(days=lt), buy))
                expected.append((key, r[1] + dt.timedelta(days=lt), buy))
            stock = max(0.0, stock + arrived - demand[i])
    assert got == sorted(expected) and got


def test_warehouse_cover_days(spark):
    rnd = random.Random(4)
    rows = [(k, days(d), float(rnd.randint(0, 60)), float(rnd.randint(-3 if k % 2 else 0, 20) * (rnd.random() < 0.8))) for k in range(8) for d in range(25)]
    out = rep.warehouse_cover_days(spark.createDataFrame(rows, "k int, dt date, stock double, out double"), ["k"], "dt", "stock", "out")
    got = {(r["k"], r["dt"]): r["wh_avl_days"] for r in out.collect()}
    for k, day, stock, _ in rows:
        best, total = 0, 0.0
        for later in sorted(r for r in rows if r[0] == k and r[1] >= day):
            total += later[3]
            if 0 < total < stock:
                best = (later[1] - day).days
        assert got[k, day] == best


def test_layers_and_their_ends(spark):
    layers = ["a", "b", "c"]
    supply = {0: (10.0, 0.0, 5.0), 1: (3.0, 100.0, 50.0), 2: (2.0, 0.0, 4.0)}
    rows = [(k, days(d), 2.0 if d != 3 else 0.0, *supply[k]) for k in supply for d in range(6)]
    df = spark.createDataFrame(rows, "k int, dt date, q double, a double, b double, c double")
    df = df.join(df.groupBy("k").agg(F.lit(1).alias("one")), "k")
    from stockwise.operators.windows import running_total

    drawn = rep.layered_drawdown(running_total(df, ["k"], "dt", "q", "used"), layers, "used")
    last = {r["k"]: (r["a_remain"], r["b_remain"], r["c_remain"]) for r in drawn.where(F.col("dt") == F.lit(days(5))).collect()}
    assert last == {0: (0.0, 0.0, 5.0), 1: (0.0, 93.0, 50.0), 2: (0.0, 0.0, 0.0)}
    ends = {r["k"]: (r["a_end"], r["b_end"], r["c_end"]) for r in rep.depletion_dates(drawn, ["k"], "dt", layers, "q").collect()}
    end = days(5)
    # Key 0: five pieces last three days beyond the end; key 1: 93 pieces last 47 days, then 50 last 25 more.
    assert ends[0] == (end, end, end + dt.timedelta(3))
    assert ends[1] == (end, end + dt.timedelta(47), end + dt.timedelta(72))
    assert ends[2] == (end, end, end)


def test_specs_fall_back_step_by_step(spark):
    pairs = spark.createDataFrame([(1, 1), (2, 1), (1, 9), (1, 7)], "wh_dept_id int, goods_id int")
    specs = spark.createDataFrame([(1, 1, 1, 5.0, 2.0), (1, 1, 0, 50.0, 9.0), (3, 1, 0, 30.0, 3.0)], "wh_dept_id int, goods_id int, city_purchase_status int, dly_use_ratio double, pur_dly_ratio double")
    config = spark.createDataFrame([(9, 8.0, 12.0)], "goods_id int, dly_use_ratio double, pur_dly_ratio double")
    out = {(r[0], r[1]): (r["dly_use_ratio"], r["pur_dly_ratio"]) for r in rep.resolved_specs(pairs, specs, config).collect()}
    assert out == {(1, 1): (5.0, 2.0), (2, 1): (50.0, 9.0), (1, 9): (8.0, 12.0), (1, 7): (None, None)}


def smooth(y, m, alpha, beta, gamma, steps):
    """Additive Holt-Winters; returns the rounded fit and forecast."""
    first, second = y[:m], y[m:2 * m]
    level = sum(first) / len(first)
    trend = (sum(second) / len(second) - level) / m
    season = [v - level for v in first]
    fit = []
    for t, v in enumerate(y):
        s = season[t]
        fit.append(round(level + trend + s, 1))
        new = alpha * (v - s) + (1 - alpha) * (level + trend)
        season.append(gamma * (v - level - trend) + (1 - gamma) * s)
        trend = beta * (new - level) + (1 - beta) * trend
        level = new
    return fit, [max(0.0, round(level + h * trend + season[len(y) + (h - 1) % m], 1)) for h in range(1, steps + 1)]


def test_holt_winters_with_both_season_lengths(spark):
    rnd = random.Random(5)
    data = {0: [float(rnd.randint(1, 50)) for _ in range(75)], 1: [float(rnd.randint(1, 50)) for _ in range(20)], 2: [1.0, 2.0]}
    df = spark.createDataFrame([(k, days(i), v) for k, y in data.items() for i, v in enumerate(y)], "k int, ds date, y double")
    out = fc.holt_winters(df, ["k"], "ds", "y", 0.3, 0.2, 0.1, 30).collect()
    fits = fc.holt_winters_fit(df, ["k"], "ds", "y", 0.3, 0.2, 0.1, 30).collect()
    assert {r["k"] for r in out} == {0, 1}
    for k, m in ((0, 30), (1, 2)):
        fit, pred = smooth(data[k], m, 0.3, 0.2, 0.1, 30)
        got = [r["pred"] for r in sorted((r for r in out if r["k"] == k), key=lambda r: r["predict_dt"])]
        assert got == pytest.approx(pred, abs=0.11)
        got = [r["pred"] for r in sorted((r for r in fits if r["k"] == k), key=lambda r: r["ds"])]
        assert got == pytest.approx(fit, abs=0.11)


def test_holt_winters_search_takes_the_best_weights(spark):
    rnd = random.Random(6)
    y = [float(rnd.randint(5, 50)) for _ in range(70)]
    df = spark.createDataFrame([(0, days(i), v) for i, v in enumerate(y)], "k int, ds date, y double")
    best = fc.holt_winters_search(df, ["k"], "ds", "y", 30).collect()[0]

    def accuracy(a, b, g):
        fit, _ = smooth(y, 30, a, b, g, 1)
        return 1 - sum(abs(f - v) / v for f, v in zip(fit, y)) / len(y)

    scores = {(a, b, g): accuracy(a, b, g) for a in fc.ALPHAS for b in fc.BETAS for g in fc.GAMMAS}
    assert best["periods"] == 30 and best["length"] == 70
    assert scores[best["alpha"], best["beta"], best["gamma"]] == pytest.approx(max(scores.values()), abs=1e-3)
    assert best["ACC"] == pytest.approx(max(scores.values()), abs=1e-3)


def test_model_recursion_equals_step_by_step_prediction(spark):
    rnd = random.Random(7)
    history = [float(rnd.randint(1, 30)) for _ in range(30)]
    df = spark.createDataFrame([(1, days(i), v) for i, v in enumerate(history)], "k int, ds date, y double")
    features = ml.feature_names(["k"], (1, 7), dates=("day", "day_of_week"))
    rows = ml.training_rows(df, ["k"], "ds", "y", (1, 7), 30)
    model = ml.fit_models(rows, features, {"forest": ml.regressors("y", 5, 5)["forest"]})["forest"]
    got = [r["pred"] for r in ml.recursive_model(df, ["k"], "ds", "y", model, (1, 7), 4, checkpoint_every=3).orderBy("predict_dt").collect()]
    held = list(history)
    for step in range(4):
        # The day to predict joins as a row without a value, and the window features are built anew.
        grown = [(1, days(i), v) for i, v in enumerate(held)] + [(1, days(len(held)), None)]
        frame = ml.lag_features(spark.createDataFrame(grown, "k int, ds date, y double"), ["k"], "ds", "y", (1, 7))
        last = frame.where(F.col("ds") == F.lit(days(len(held)))).na.fill(0.0)
        held.append(round(model.transform(last).collect()[0]["prediction"], 1))
    assert got == [max(0.0, v) for v in held[30:]]


def test_bent_trend_finds_planted_knots(spark):
    rnd = random.Random(12)
    rows, planted = [], {}
    for k in range(6):
        at, slope, bend = 20 * (k + 1), rnd.choice([-1.0, 0.5, 2.0]), rnd.choice([-3.0, 4.0])
        planted[k] = (days(at), slope, bend)
        rows += [(k, days(d), 500 + slope * d + bend * max(0, d - at) + rnd.random() * 0.2) for d in range(201) if rnd.random() < 0.9 or d in (0, 200)]
    rows += [(7, days(d), 5.0 + d) for d in range(201)] + [(8, days(0), 1.0)]
    df = spark.createDataFrame(rows, "k int, ds date, y double")
    first, last = F.lit(DAY).cast("date"), F.lit(days(200)).cast("date")
    found = {r["k"]: r for r in fc.bent_trend(df, ["k"], "ds", "y", first, last).collect()}
    assert set(found) == {*planted, 7}
    for k, (knot, slope, bend) in planted.items():
        assert found[k]["knot"] == knot
        assert found[k]["slope"] == pytest.approx(slope, abs=0.02) and found[k]["bend"] == pytest.approx(bend, abs=0.02)
    assert (found[7]["knot"], found[7]["bend"]) == (None, 0.0) and found[7]["slope"] == pytest.approx(1.0)
    ahead = fc.bent_forecast(fc.bent_trend(df, ["k"], "ds", "y", first, last), ["k"], F.lit(days(201)).cast("date"), 5)
    for r in ahead.collect():
        d = (r["predict_dt"] - DAY).days
        if r["k"] in planted:
            knot, slope, bend = planted[r["k"]]
            assert r["pred"] == pytest.approx(max(0, 500 + slope * d + bend * (d - (knot - DAY).days)), abs=3)


def test_tuned_weights_equal_a_plain_loop(spark):
    rnd = random.Random(3)
    rows = [(k, days(d), float(round(30 + 10 * math.sin(d + k) + rnd.random() * 20 + d * k / 4))) for k in range(3) for d in range(20)]
    df = spark.createDataFrame(rows, "k int, ds date, y double")
    grid = {r["k"]: r for r in fc.holt_winters_search(df, ["k"], "ds", "y", 30).collect()}
    tuned = {r["k"]: r for r in fc.holt_winters_tuned(df, ["k"], "ds", "y", 30, rounds=2).collect()}

    def accuracy(y, p, a, b, g):
        first, second = y[:p], y[p : 2 * p]
        level = sum(first) / p
        trend, season, miss = (sum(second) / p - level) / p, [v - sum(first) / p for v in first], 0.0
        for v in y:
            ahead, head = level + trend, season[0]
            fitted = round(round((ahead + head) * 10) / 10, 10)
            new = a * (v - head) + (1 - a) * ahead
            trend, season = b * (new - level) + (1 - b) * trend, season[1:] + [g * (v - ahead) + (1 - g) * head]
            level, miss = new, miss + abs(fitted - v) / max(abs(v), 2.220446049250313e-16)
        return round(1 - round(miss / len(y) * 1e4) / 1e4, 4)

    for k in range(3):
        y = [r[2] for r in sorted(r for r in rows if r[0] == k)]
        point = [grid[k][c] for c in ("alpha", "beta", "gamma")]
        best = accuracy(y, 2, *point)
        assert best == pytest.approx(grid[k]["ACC"], abs=1e-9)
        for turn in range(12):
            step = 0.5 ** (turn // 6 + 3) * (1 if turn % 2 == 0 else -1)
            tried = list(point)
            at = turn // 2 % 3
            tried[at] = min(max(tried[at] + step, 0.01), 0.99)
            if accuracy(y, 2, *tried) > best + 1e-9:
                best, point = accuracy(y, 2, *tried), tried
        assert [tuned[k][c] for c in ("alpha", "beta", "gamma")] == pytest.approx(point)
        assert tuned[k]["ACC"] == pytest.approx(best) and tuned[k]["ACC"] >= grid[k]["ACC"]


def test_positions_with_a_prefix_that_holds_half_of_the_rows(spark):
    rnd = random.Random(6)
    rows = [(0 if k % 2 else k, rnd.randrange(1000), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int, c int").repartition(7)
    found = series.positional_rank(df, ["a", "b", "c"], ranges=16)
    assert [(r.a, r.b, r.c) for r in found.orderBy("position").collect()] == sorted(rows)
    assert sorted(r.position for r in found.collect()) == list(range(1, 3001))
    # No window holds the prefix: its rows are spread over half of the ranges.
    dealt = df.repartitionByRange(16, "a", "b", "c").withColumn("range", F.spark_partition_id()).where("a = 0")
    assert dealt.select("range").distinct().count() >= 7
    assert series.positional_rank(df.limit(0), ["a", "b", "c"]).collect() == []


def test_recent_launches(spark):
    rows = [("a", days(10))] * 3 + [("a", days(18))] * 2 + [("b", days(12))] * 3 + [("c", days(0))] * 5 + [("d", days(21))] * 5 + [("e", days(1))] * 3
    plan = spark.createDataFrame(rows, "com string, launch date")
    found = quality.recent_launches(plan, "com", "launch", F.lit(days(21)).cast("date"), 21, 3)
    # The last launch of a is too small, c lies on the open lower end, d on the run day.
    assert sorted(map(tuple, found.collect())) == [("b", days(12), 3), ("e", days(1), 3)]
