"""Replenishment and stock planning as table operators.

Plans are dense: one row per key and day.  The ordered operators (roll-forward, order plan,
call-off plan) work per key on at most one planning calendar.  Operators over stores of one
warehouse, where a group has no such bound, go through aggregated histograms instead.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockwise.functions.numeric import at_least, box_round, ceil_to_multiple, ceil_units, clamp, half_even
from stockwise.operators.windows import by, forward_sum_dynamic, top_rows
from stockwise.session import staged


def filled(name: str) -> Column:
    """Missing quantities count as zero."""
    return F.coalesce(F.col(name), F.lit(0.0))


def stock_rollforward(
    df: DataFrame, keys: Sequence[str], time: str, opening: str, inflow: str, outflow: str
) -> DataFrame:
    """Begin and end stock per day, where the end may not fall below zero and opens the next day.

    With X the stock without a floor, the end is X less the lowest X so far where that is negative.
    """
    spec = by(keys, time)
    so_far = spec.rowsBetween(Window.unboundedPreceding, 0)
    first = F.first(opening).over(spec.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    free = df.withColumn("_free", F.coalesce(first, F.lit(0.0)) + F.sum(filled(inflow) - filled(outflow)).over(so_far))
    floored = free.withColumn("stock_end", F.col("_free") - F.least(F.lit(0.0), F.min("_free").over(so_far)))
    begin = F.coalesce(F.lag("stock_end").over(spec), first, F.lit(0.0))
    return floored.withColumn("stock_beg", begin).drop("_free")


def order_quantity(stock: Column, need: Column, until_arrival: Column, box: Column) -> dict[str, Column]:
    """Order columns from projected stock, wanted level and the demand until the order arrives."""
    projected = at_least(stock - until_arrival)
    calc = at_least(at_least(need) - projected)
    return {"pred_vlt_end": projected, "order_calc": calc, "order_num": box_round(calc, box)}


def later_sum(df: DataFrame, keys: Sequence[str], time: str, value: str, out: str) -> DataFrame:
    """Sum over all later days of the key."""
    later = by(keys, time).rowsBetween(1, Window.unboundedFollowing)
    return df.withColumn(out, F.coalesce(F.sum(value).over(later), F.lit(0.0)))


def sort_key(df: DataFrame, name: str) -> Column:
    """Whole numbers and texts as hexadecimal text whose order is theirs and of which none begins another."""
    if df.schema[name].dataType.typeName() == "string":
        return F.concat(F.hex(F.col(name)), F.lit("."))
    return F.concat(F.lpad(F.hex(F.col(name).cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"), F.lit("."))


def nth_smallest(rows: DataFrame, group: Sequence[str], key: str, place: str, digits: int = 4) -> DataFrame:
    """Per group a prefix ``_until`` of keys: as many keys as ``place`` says are not above it, each cut to its length.

    rows: distinct keys per group, as from ``sort_key``, with the wanted number, below or equal to that of the group's keys.
    Radix selection: the keys are counted by their next ``digits`` digits, which tells the one cell that the place falls
    into, and only this cell's keys are looked at again.  A window holds one row per cell, ``17 ** digits`` at most and never more than
    there are keys; a group may have any number of keys, however they are spread.
    """
    ends = rows.select(F.min(key).alias("low"), F.max(key).alias("high")).first()
    low, high = ends["low"] or "", ends["high"] or ""
    common = next((k for k, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), max(0, len(low) - 1))
    left = rows.select(*group, F.col(key).alias("_key"), F.col(place).cast("long").alias("_place"))
    done, length = None, common
    while True:
        cell = F.substring("_key", length + 1, digits)
        cells = left.groupBy(*group, cell.alias("_cell")).agg(
            F.count(F.lit(1)).alias("_n"), F.max("_place").alias("_place"), F.min(F.substring("_key", 1, length + digits)).alias("_until")
        )
        counted = cells.withColumn("_upto", F.sum("_n").over(by(group, "_cell")))
        hit = counted.where((F.col("_upto") >= F.col("_place")) & (F.col("_upto") - F.col("_n") < F.col("_place")))
        hit = staged(hit.select(*group, "_until", "_n", (F.col("_place") - F.col("_upto") + F.col("_n")).alias("_rest")), "cells")
        whole = hit.where(F.col("_rest") == F.col("_n")).select(*group, "_until")
        done = whole if done is None else done.unionByName(whole)
        split = hit.where(F.col("_rest") < F.col("_n"))
        length += digits
        if split.isEmpty():
            return done
        inside = left.drop("_place").join(split.select(*group, "_until", F.col("_rest").alias("_place")), list(group))
        left = staged(inside.where(F.substring("_key", 1, length) == F.col("_until")).drop("_until"), "keys")


def shortage_allocation(
    df: DataFrame, group: Sequence[str], store: str, order: str, stock: str, box: str
) -> DataFrame:
    """Grant whole orders where the stock suffices, else one box per store in rounds, largest order first.

    ``stock`` and ``box`` are constant in a group; ``store`` is a whole number or a text (in order of its bytes), unique in the group.
    A round ends when the stock is used up, and the last box may overshoot it.

    A group may hold any share of all stores, so nothing is ordered over its rows.  Stores are
    counted per order size; from the counts follow the last round, the order size at which it
    stops, and how many stores of that size still get a box.  Only this last cut needs stores in
    order, and it is found by radix selection (``nth_smallest``), whatever the ids look like.
    """
    whole = by(group)
    sizes = df.groupBy(*group, order).agg(
        F.count("*").alias("_cnt"), F.max(stock).alias("_stock"), F.max(box).alias("_box")
    ).withColumn("_total", F.sum(F.col("_cnt") * F.col(order)).over(whole))
    short = sizes.where((F.col("_stock") < F.col("_total")) & (F.col(order) > 0))

    # After round j a size has min(order, j * box) per store.  Between the rounds in which sizes are
    # completed the granted total grows evenly, so the last round follows without walking the rounds.
    boxed = short.withColumn("_rounds", F.ceil(F.col(order) / F.col("_box")))
    done_before = by(group, "_rounds").rangeBetween(Window.unboundedPreceding, -1)
    done_then = by(group, "_rounds").rangeBetween(Window.unboundedPreceding, 0)
    granted_full, stores = F.col("_cnt") * F.col(order), F.sum("_cnt").over(whole)
    boxed = boxed.withColumns(
        {
            "_full": F.coalesce(F.sum(granted_full).over(done_before), F.lit(0.0)),
            "_open": stores - F.coalesce(F.sum("_cnt").over(done_before), F.lit(0)),
            "_given": F.sum(granted_full).over(done_then)
            + (stores - F.sum("_cnt").over(done_then)) * F.col("_rounds") * F.col("_box"),
        }
    )
    enough = boxed.where((F.col("_stock") > 0) & (F.col("_given") >= F.col("_stock")))
    ending = enough.groupBy(*group).agg(
        F.min_by(F.struct("_rounds", "_full", "_open", "_stock", "_box"), "_rounds").alias("_e")
    )
    ending = ending.select(*group, "_e.*")
    even = F.ceil((F.col("_stock") - F.col("_full")) / (F.col("_open") * F.col("_box")))
    ending = ending.withColumn("_last", F.least(F.col("_rounds"), even))
    left = F.col("_stock") - F.col("_full") - F.col("_open") * (F.col("_last") - 1) * F.col("_box")
    last = ending.select(*group, "_last", left.alias("_left"))

    # How many stores of each size get their box in the last round.
    cut = boxed.join(last, list(group)).where(F.col("_rounds") >= F.col("_last"))
    amount = F.least(F.col("_box"), F.col(order) - (F.col("_last") - 1) * F.col("_box"))
    cut = cut.withColumn("_amount", amount)
    larger = by(group, F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    taken = F.coalesce(F.sum(F.col("_cnt") * F.col("_amount")).over(larger), F.lit(0.0))
    fits = F.ceil((F.col("_left") - taken) / F.col("_amount"))
    cut = cut.withColumn("_fit", F.greatest(F.least(fits, F.col("_cnt")), F.lit(0)).cast("long"))

    # The one size that is served in part: up to which store.
    partial = staged(cut.where((F.col("_fit") > 0) & (F.col("_fit") < F.col("_cnt"))).select(*group, order, "_fit"), "partial")
    keyed = df.select(*group, order, sort_key(df, store).alias("_key")).join(partial, [*group, order])
    threshold = nth_smallest(staged(keyed, "keys"), [*group, order], "_key", "_fit")

    # Everything the rows need, one line per order size, so that the rows are joined once.
    facts = (
        sizes.select(*group, order, "_total", "_cnt")
        .join(last.select(*group, "_last"), list(group), "left")
        .join(cut.select(*group, order, "_amount", "_fit"), [*group, order], "left")
        .join(threshold, [*group, order], "left")
    )
    rows = df.join(facts, [*group, order])
    # Without stock there is no last round, and nothing is granted.
    rounds_before = F.coalesce(F.col("_last"), F.lit(1)) - 1
    full_rounds = F.least(F.col(order), rounds_before * F.col(box))
    own = F.substring(sort_key(df, store), F.lit(1), F.length("_until"))
    served = F.coalesce((F.col("_fit") == F.col("_cnt")) | (own <= F.col("_until")), F.lit(False))
    granted = F.when(F.col(stock) >= F.col("_total"), F.col(order)).otherwise(
        full_rounds + F.when(served, F.col("_amount")).otherwise(F.lit(0.0))
    )
    return rows.select(*df.columns, granted.alias("resign"))


def warehouse_balance(stock: DataFrame, transit: DataFrame, orders: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Begin, end and short quantity of a warehouse day."""
    arriving = transit.groupBy(*keys).agg(F.sum("transit").alias("transit"))
    ordered = orders.groupBy(*keys).agg(F.sum("order_num").alias("wh_order_sum"))
    day = stock.join(arriving, list(keys), "left").join(ordered, list(keys), "left").na.fill(0.0)
    day = day.withColumn("wh_begin", F.col("beg_wh_stock") + F.col("transit"))
    return day.withColumns(
        {
            "wh_end": at_least(F.col("wh_begin") - F.col("wh_order_sum")),
            "wh_short": at_least(F.col("wh_order_sum") - F.col("wh_begin")),
        }
    )


LEDGER = "array<struct<day:date,qty:double>>"


def _ledger_sum(ledger: Column, keep) -> Column:
    return F.aggregate(F.filter(ledger, keep), F.lit(0.0), lambda acc, x: acc + x["qty"])


def _folded(df: DataFrame, keys: Sequence[str], columns: Sequence[Column]) -> DataFrame:
    """One row per key with its days in order; the day comes first in the struct."""
    days = F.array_sort(F.collect_list(F.struct(*columns)))
    return df.groupBy(*keys).agg(days.alias("_days"))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, as the only element of an array."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _on_day(s: Column, d: Column) -> Column:
    """Stock on hand with the day's arrivals, and the arrivals still to come."""
    return F.struct(
        (s["stock"] + _ledger_sum(s["ledger"], lambda x: x["day"] == d["dt"])).alias("on_hand"),
        F.filter(s["ledger"], lambda x: x["day"] > d["dt"]).alias("open"),
    )


def _open_sum(ledger: Column) -> Column:
    return F.aggregate(ledger, F.lit(0.0), lambda acc, x: acc + x["qty"])


def reorder_plan(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Orders of each store, goods and version without a limit on the supply.

    The days of a key are folded in order.  The state is the stock, the open arrivals and the
    orders so far.  An order placed for a receive day that has passed is lost.
    """
    quantities = ("expected_receive", "pred_consume", "vlt_consume", "bp_consume", "ss_ro", "dly_use_ratio", "shop_beg")
    plan = _folded(
        df, keys, [F.col("dt"), F.col("can_order"), F.col("receive_day"), *(filled(q).alias(q) for q in quantities)]
    )
    expected = F.transform(
        F.filter("_days", lambda d: d["expected_receive"] > 0),
        lambda d: F.struct(d["dt"].alias("day"), d["expected_receive"].alias("qty")),
    )
    out = "array<struct<dt:date,receive_day:date,order_calc:double,order_num:double>>"
    start = F.struct(
        F.get("_days", F.lit(0))["shop_beg"].alias("stock"), expected.cast(LEDGER).alias("ledger"), F.array().cast(out).alias("orders")
    )

    def day(s: Column, d: Column) -> Column:
        def placed(available: Column) -> Column:
            q = order_quantity(available, d["bp_consume"] + d["ss_ro"], d["vlt_consume"], d["dly_use_ratio"])
            order = F.struct(d["dt"].alias("dt"), d["receive_day"].alias("receive_day"), q["order_calc"].alias("order_calc"), q["order_num"].alias("order_num"))
            return F.when(d["can_order"] == 1, F.array(order)).otherwise(F.array().cast(out))

        def evening(k: Column, new: Column) -> Column:
            arrivals = F.transform(new, lambda o: F.struct(o["receive_day"].alias("day"), o["order_num"].alias("qty")))
            return F.struct(
                at_least(k["on_hand"] - d["pred_consume"]).alias("stock"),
                F.concat(k["open"], arrivals).cast(LEDGER).alias("ledger"),
                F.concat(s["orders"], new).cast(out).alias("orders"),
            )

        return bound(
            _on_day(s, d),
            lambda k: bound(bound(k["on_hand"] + _open_sum(k["open"]), placed), lambda new: evening(k, new)),
        )

    folded = plan.withColumn("_state", F.aggregate("_days", start, day))
    return folded.select(*keys, F.inline("_state.orders"))


def opening_stock_ledger(df: DataFrame, keys: Sequence[str], time: str, stock: str, transit: str) -> DataFrame:
    """Opening stock as an arrival on the first day, together with the actual transit."""
    opening = df.groupBy(*keys).agg(F.min(time).alias(time), F.max(stock).alias("transit"))
    actual = df.where(F.col(transit) > 0).select(*keys, time, F.col(transit).alias("transit"))
    return opening.unionByName(actual).groupBy(*keys, time).agg(F.sum("transit").alias("transit"))


def leadtime_demand(df: DataFrame, keys: Sequence[str], time: str = "dt", demand: str = "theory_order_sum") -> DataFrame:
    """Demand over the lead time, over lead time plus cover period, and the proportional safety stock."""
    span = F.col("lt_cg") + F.col("bp_cg")
    summed = forward_sum_dynamic(df, keys, time, demand, {"lt_consume": F.col("lt_cg"), "bp_lt_consume": span})
    safety = F.try_divide(F.col("bp_lt_consume"), span.cast("double")) * F.col("ss_cg")
    return summed.withColumn("ss_amount", F.coalesce(safety, F.lit(0.0)))


def calloff_plan(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Call-offs per warehouse and goods from the open purchase quantity.

    Folds the days like the order plan; the state also carries the quantity that is still open.
    Every call-off arrives after the lead time.
    """
    # The opening stock arrives on the first day; the window shares its layout with the demand sums.
    whole = by(keys, "dt").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    opening = F.when(F.col("dt") == F.min("dt").over(whole), F.max("beg_wh_stock").over(whole)).otherwise(F.lit(0.0))
    arriving = F.when(F.col("transit") > 0, F.col("transit")).otherwise(F.lit(0.0))
    days = leadtime_demand(df, keys).withColumn("_arrives", opening + arriving)
    quantities = ("_arrives", "theory_order_sum", "lt_consume", "bp_lt_consume", "ss_amount", "pur_use_ratio", "po_remain")
    plan = _folded(
        days, keys, [F.col("dt"), F.date_add("dt", F.col("lt_cg").cast("int")).alias("finish"), *(filled(q).alias(q) for q in quantities)]
    )
    arrivals = F.transform("_days", lambda d: F.struct(d["dt"].alias("day"), d["_arrives"].alias("qty")))
    out = "array<struct<dt:date,transit:double>>"
    start = F.struct(
        F.lit(0.0).alias("stock"),
        F.get("_days", F.lit(0))["po_remain"].alias("po"),
        arrivals.cast(LEDGER).alias("ledger"),
        F.array().cast(out).alias("orders"),
    )

    def day(s: Column, d: Column) -> Column:
        need = at_least(d["bp_lt_consume"] - d["lt_consume"] + d["ss_amount"])

        def wanted(available: Column) -> Column:
            projected = at_least(available - d["lt_consume"])
            return bound(at_least(need - projected), lambda gap: ceil_to_multiple(gap, d["pur_use_ratio"]))

        def evening(k: Column, w: Column) -> Column:
            called = F.least(w, s["po"])
            arrival = F.array(F.struct(d["finish"].alias("day"), called.alias("qty")))
            order = F.array(F.struct(d["finish"].alias("dt"), called.alias("transit")))
            return F.struct(
                at_least(k["on_hand"] - d["theory_order_sum"]).alias("stock"),
                at_least(s["po"] - w).alias("po"),
                F.when(called > 0, F.concat(k["open"], arrival)).otherwise(k["open"]).cast(LEDGER).alias("ledger"),
                F.when(called > 0, F.concat(s["orders"], order)).otherwise(s["orders"]).cast(out).alias("orders"),
            )

        return bound(
            _on_day(s, d),
            lambda k: bound(bound(k["on_hand"] + _open_sum(k["open"]), wanted), lambda w: evening(k, w)),
        )

    folded = plan.withColumn("_state", F.aggregate("_days", start, day))
    return folded.select(*keys, F.inline("_state.orders"))


def warehouse_cover_days(df: DataFrame, keys: Sequence[str], time: str, stock: str, outflow: str) -> DataFrame:
    """Days until the last later day whose summed outflow is positive and below the stock; 0 if none.

    Where no outflow is negative the running outflow never falls, and the last day below a level is found by order: levels asked
    for and days reached stand in one sorted list per key, in which the last day before a question is the answer.  Keys with a
    negative outflow compare every day with every later one.  A day with an unknown outflow has 0.
    """
    so_far, whole = by(keys, time).rowsBetween(Window.unboundedPreceding, 0), by(keys)
    day, out = F.col(time).alias("_t"), F.col(outflow)
    summed = df.select(
        *keys, day, F.col(stock).alias("_stock"), (F.sum(out).over(so_far) - out).alias("_before"), F.sum(out).over(so_far).alias("_after"),
        (F.min(out).over(whole.orderBy(time).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) < 0).alias("_falls"),
    )
    falls = F.coalesce(F.col("_falls"), F.lit(False))

    steady = summed.where(~falls)
    entry = F.struct((F.col("_before") + F.col("_stock")).alias("_level"), F.lit(0).alias("_kind")), F.struct(F.col("_after").alias("_level"), F.lit(1).alias("_kind"))
    listed = steady.select(*keys, "_t", "_before", "_after", F.inline(F.array(*entry)))
    # A day that just reaches the level is not below it: it sorts after the question.
    asked = by(keys, "_level", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.max(F.when((F.col("_kind") == 1) & F.col("_level").isNotNull(), F.struct("_t", "_after"))).over(asked)
    found = listed.withColumn("_last", reached).where(F.col("_kind") == 0)
    inside = (F.col("_last._t") >= F.col("_t")) & (F.col("_last._after") > F.col("_before")) & F.col("_level").isNotNull()
    days = F.when(inside, F.date_diff("_last._t", "_t")).otherwise(0)
    searched = found.select(*keys, F.col("_t").alias(time), days.cast("long").alias("wh_avl_days"))

    folded = _folded(summed.where(falls), keys, [F.col(c) for c in ("_t", "_stock", "_before", "_after")])

    def cover(d: Column) -> Column:
        def covered(p: Column) -> Column:
            used = p["_after"] - d["_before"]
            return (p["_t"] >= d["_t"]) & (used > 0) & (used < d["_stock"])

        last = F.array_max(F.transform(F.filter("_days", covered), lambda p: p["_t"]))
        return F.struct(d["_t"].alias(time), F.coalesce(F.date_diff(last, d["_t"]), F.lit(0)).cast("long").alias("wh_avl_days"))

    return searched.unionByName(folded.select(*keys, F.inline(F.transform("_days", cover))))


def store_cover_days(df: DataFrame, keys: Sequence[str], time: str, stock: str, demand: str) -> DataFrame:
    """Whole days of stock at the mean demand of the current and the next six days; 0 without demand."""
    mean = F.avg(demand).over(by(keys, time).rowsBetween(0, 6))
    days = F.when(mean == 0, F.lit(0)).otherwise(F.floor(F.try_divide(F.col(stock), mean)))
    return df.withColumn("shop_avl_days", days.cast("long"))


def in_stock_rate(df: DataFrame, group: Sequence[str], time: str, store: str, available: Column) -> DataFrame:
    """Open stores with goods available per day, over all stores of the group."""
    stores = df.groupBy(*group).agg(F.count_distinct(store).alias("shop_cnt"))
    open_rows = df.where(F.col("closed") == 0)
    counted = open_rows.groupBy(*group, time).agg(F.sum((available > 0).cast("long")).alias("in_stock"))
    return counted.join(stores, list(group)).withColumn("shop_avl_rate", F.col("in_stock") / F.col("shop_cnt"))


def layered_drawdown(df: DataFrame, layers: Sequence[str], consumed: str) -> DataFrame:
    """What is left of each supply layer when the summed consumption eats them in order."""
    earlier: Column = F.lit(0.0)
    columns = {}
    for layer in layers:
        columns[f"{layer}_remain"] = at_least(F.col(layer) - at_least(F.col(consumed) - earlier))
        earlier = earlier + F.col(layer)
    return df.withColumns(columns)


def recent_positive_mean(df: DataFrame, keys: Sequence[str], time: str, value: str, n: int, out: str) -> DataFrame:
    """Mean of the last ``n`` positive days per key."""
    last = top_rows(df.where(F.col(value) > 0), keys, [F.desc(time)], n)
    return last.groupBy(*keys).agg(F.avg(value).alias(out))


def depletion_dates(df: DataFrame, keys: Sequence[str], time: str, layers: Sequence[str], demand: str) -> DataFrame:
    """End date per supply layer, from rows that carry the remains of ``layered_drawdown``.

    A layer ends on its first day without a remain, yet not before its start; if it outlives the
    calendar, the remain at the end is divided by the mean of the last seven positive days.
    """
    ends = df.groupBy(*keys).agg(
        F.min(time).alias("dt_start"),
        F.max(time).alias("dt_end"),
        *(F.min(F.when(F.col(f"{c}_remain") == 0, F.col(time))).alias(f"_zero_{c}") for c in layers),
        *(F.max_by(f"{c}_remain", time).alias(f"{c}_left") for c in layers),
        *(F.max(c).alias(c) for c in layers),
    )
    ends = ends.join(recent_positive_mean(df, keys, time, demand, 7, "last_seven"), list(keys), "left")
    previous = None
    for layer in layers:
        start = F.col("dt_end") if previous is None else F.greatest(previous, F.col("dt_end"))
        extra = F.ceil(F.try_divide(F.col(f"{layer}_left"), F.col("last_seven"))).cast("int")
        zero = F.col(f"_zero_{layer}")
        end = F.when(zero.isNotNull(), F.greatest(zero, start)).otherwise(F.date_add(start, extra))
        if previous is not None:
            end = F.when(F.col(layer) == 0, F.greatest(end, previous)).otherwise(end)
        ends = ends.withColumn(f"{layer}_end", end)
        previous = F.col(f"{layer}_end")
    return ends.drop(*(f"_zero_{c}" for c in layers))


def stockup_bands(df: DataFrame, keys: Sequence[str], time: str, launch: Column, quantity: str) -> DataFrame:
    """Demand of the first delivery, the finished goods and the raw material band.

    Keys without a row in the first band are left out.
    """
    end1 = F.date_add(launch, (F.col("wh_bp") + F.col("wh_lt")).cast("int"))
    end2 = F.date_add(end1, F.col("pt").cast("int"))
    end3 = F.date_add(end2, F.col("mt").cast("int"))
    day, qty = F.col(time), F.col(quantity)
    summed = df.groupBy(*keys).agg(
        F.sum(F.when(day <= end1, qty)).alias("po1_amount"),
        F.sum(F.when((day > end1) & (day <= end2), qty)).alias("po2_amount"),
        F.sum(F.when((day > end2) & (day <= end3), qty)).alias("po3_amount"),
    )
    return summed.where(F.col("po1_amount").isNotNull()).na.fill(0.0, ["po2_amount", "po3_amount"])


def proportional_allocation(df: DataFrame, group: Sequence[str], need: Column, total: Column, out: str) -> DataFrame:
    """Whole units of ``total`` by each row's share of the need of its group, or of the whole table."""
    if group:
        summed = df.join(df.groupBy(*group).agg(F.sum(need).alias("_need")), list(group))
    else:
        summed = df.withColumn("_need", df.select(F.sum(need)).scalar())
    share = F.try_divide(need, F.col("_need"))
    return summed.withColumn("dis_ratio", share).withColumn(out, half_even(total * share)).drop("_need")


def expiry_risk(ends: DataFrame, consumed_before: Column, layers: Sequence[str], last_layer: str) -> DataFrame:
    """Quantity that expires unused: inside the calendar, or beyond it but before the supply ends."""
    supply = sum((F.col(c) for c in layers[1:]), F.col(layers[0]))
    beyond = F.date_diff(F.col(f"{last_layer}_end"), F.col("expire_day")) * F.col("last_seven")
    expired = (
        F.when(F.col("expire_day") <= F.col("dt_end"), supply - consumed_before)
        .when(F.col("expire_day") < F.col(f"{last_layer}_end"), supply - consumed_before - beyond)
        .otherwise(F.lit(0.0))
    )
    left = sum((F.col(f"{c}_left") for c in layers[1:]), F.col(f"{layers[0]}_left"))
    risky = ends.withColumns(
        {
            "estimated_expired_quantity": ceil_units(expired, F.col("pur_use_ratio")),
            "over_plan_quantity": ceil_units(left, F.col("pur_use_ratio")),
        }
    )
    return risky.withColumn("is_expire_risk", (F.col("estimated_expired_quantity") != 0).cast("long"))


def reorder_factor(base: DataFrame, formula: DataFrame, strategy: DataFrame, ratio: DataFrame) -> DataFrame:
    """Reorder factor per store, goods and version from first-week and target consumption."""
    per_cup = base.join(ratio, "dept_id").join(formula, "commodity_id").join(strategy, "commodity_id", "left")
    weight = F.col("sku_average_number") * F.col("dis_ratio")
    keys = ["version_id", "dept_id", "wh_dept_id", "goods_id", "ct_bp_days", "ct_last_order_day"]
    summed = per_cup.groupBy(*keys).agg(
        F.sum(weight * F.col("first_week_cup_quantity_avg")).alias("first_week_consume"),
        F.sum(weight * F.col("target_value")).alias("target_consume"),
    )
    raw = F.try_divide(F.col("target_consume"), F.col("first_week_consume")) * (F.col("ct_bp_days") + 1) - F.col("ct_bp_days")
    return summed.withColumn("ro", clamp(half_even(raw, 2), 2.0, 100.0))


def calendar_consumption(
    calendar: DataFrame, chance: DataFrame, daily: DataFrame, void: Mapping[str, Column]
) -> DataFrame:
    """Consumption over the days an order day covers, in one join and one aggregate for all columns of ``void``.

    ``void`` maps an output column to the condition under which a row counts as zero in it.
    """
    joined = calendar.join(chance, ["dt", "dept_id"]).join(daily, ["dept_id", "goods_id", "predict_date"])
    sums = [F.sum(F.when(empty, 0.0).otherwise(F.col("shop_com_consume"))).alias(out) for out, empty in void.items()]
    return joined.groupBy("dt", "dept_id", "goods_id", "version_id").agg(*sums)


def launch_type(df: DataFrame, keys: Sequence[str], launch: str, cold_start_days: int) -> DataFrame:
    """1 for one launch day, 2 for launches within eleven days, 3 for a longer spread."""
    first, last = F.min(launch), F.max(launch)
    spans = df.groupBy(*keys).agg(first.alias("min_launch_date"), last.alias("max_launch_date"))
    gap = F.date_diff("max_launch_date", "min_launch_date")
    return spans.withColumns(
        {
            "new_type": F.when(gap == 0, 1).when(gap <= 11, 2).otherwise(3).cast("long"),
            "min_cs_start": F.date_sub("min_launch_date", cold_start_days),
        }
    )


def resolved_specs(pairs: DataFrame, specs: DataFrame, config: DataFrame) -> DataFrame:
    """Box sizes of the wanted warehouse and goods pairs.

    First the largest valid spec of the warehouse, then the largest of the goods anywhere, then the
    configured one.  The nation-wide value is looked up per pair instead of being spread over all
    warehouses.
    """
    sizes = ("dly_use_ratio", "pur_dly_ratio")
    valid = specs.where(F.col("city_purchase_status") == 1).groupBy("goods_id", "wh_dept_id").agg(*(F.max(c).alias(f"_valid_{c}") for c in sizes))
    nation = specs.groupBy("goods_id").agg(*(F.max(c).alias(f"_nation_{c}") for c in sizes))
    configured = config.select("goods_id", *(F.col(c).alias(f"_config_{c}") for c in sizes))
    found = pairs.join(valid, ["goods_id", "wh_dept_id"], "left").join(nation, "goods_id", "left").join(configured, "goods_id", "left")
    return found.select(*pairs.columns, *(F.coalesce(f"_valid_{c}", f"_nation_{c}", f"_config_{c}").alias(c) for c in sizes))


def replenish_gap(need: Column, covers: Sequence[Column], unit: Column) -> Column:
    """Need less everything on its way or in stock, floored at zero, in whole purchase units."""
    gap = need
    for cover in covers:
        gap = gap - cover
    return ceil_to_multiple(at_least(gap), unit)


def plan_base(
    daily: DataFrame,
    labels: DataFrame,
    chance: DataFrame,
    consumed: DataFrame,
    bp_days: DataFrame,
    factors: DataFrame,
    specs: DataFrame,
    default_factor: float,
) -> DataFrame:
    """Planning base of a store day; ``consumed`` holds ``bp_consume`` and ``vlt_consume``.

    Consumption before the launch counts as zero, a second order on a day is not possible, a day
    without a receive day is left out.
    """
    keys = ["dt", "dept_id", "goods_id", "version_id"]
    base = labels.join(daily.withColumnRenamed("predict_date", "dt"), ["dt", "goods_id"], "left")
    base = base.join(chance, ["dt", "dept_id", "goods_id"], "left").join(consumed, keys, "left")
    base = base.na.fill(0.0, ["bp_consume", "vlt_consume"])
    before = F.col("dt") < F.col("min_launch_date")
    base = base.withColumns(
        {
            "can_order": F.when(F.col("order_cnt") > 1, 0).otherwise(F.col("can_order")),
            "pred_consume": F.when(before, 0.0).otherwise(F.col("shop_com_consume")),
        }
    )
    base = base.join(bp_days, "dept_id", "left").na.fill({"bp_days": 1.0})
    base = base.join(factors, keys, "left").na.fill({"ro": default_factor})
    level = F.try_divide(F.col("bp_consume"), F.col("bp_days")) * F.col("ro")
    base = base.withColumn("ss_ro", F.coalesce(level, F.lit(0.0)))
    sized = base.join(specs, ["wh_dept_id", "goods_id"]).withColumns({"shop_beg": F.lit(0.0), "expected_receive": F.lit(0.0)})
    return sized.where(F.col("receive_day").isNotNull())


def version_outflow(orders: DataFrame, base: DataFrame) -> DataFrame:
    """Outflow per version, warehouse, goods and day with lead time and open purchase quantity."""
    summed = orders.groupBy("dt", "version_id", "goods_id", "wh_dept_id").agg(F.sum("order_num").alias("theory_order_sum"))
    return summed.join(base, ["wh_dept_id", "goods_id"]).withColumns(
        {"lt_cg": F.col("wt") + F.col("vlt_cg"), "po_remain": F.col("po3_amount") + F.col("po2_amount")}
    )


def availability_mart(
    calendar: DataFrame, facts: Sequence[DataFrame], history: DataFrame, keys: Sequence[str], tags: Mapping[str, Column]
) -> DataFrame:
    """Calendar with all facts beside it; a recorded in-stock rate overrides the computed one."""
    mart = calendar
    for fact in facts:
        mart = mart.join(fact, list(keys), "left")
    mart = mart.na.fill(0, ["pred_consume", "order_num", "shop_avl_days", "wh_avl_days"])
    mart = mart.join(history, list(keys), "left")
    rate = F.coalesce("shop_actual_avl_rate", "shop_avl_rate", F.lit(0.0))
    mart = mart.withColumn("shop_avl_rate", half_even(rate, 5)).withColumns(dict(tags))
    return mart.withColumnsRenamed({"dt": "predict_dt", "pred_consume": "shop_consume_amount", "order_num": "wh_consume_amount"})
