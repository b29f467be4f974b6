"""Edges of the column expressions, windows, sources and selection."""

import datetime as dt
import random
import statistics
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from stockwise.functions import numeric as num
from stockwise.operators import accuracy as acc
from stockwise.operators import forecast as fc
from stockwise.operators import quality, selection, series
from stockwise import session
from stockwise.operators import windows as win
from stockwise.plans.inputs import Inputs
from stockwise.sources import readers, sinks

DAY = dt.date(2024, 1, 1)


def days(n):
    return DAY + dt.timedelta(days=n)


def values(df, column):
    return [r[column] for r in df.collect()]


def test_rounding_is_half_even(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.4,)], "x double")
    assert values(df.select(num.half_even(F.col("x")).alias("r")), "r") == [0.0, 2.0, 2.0, 0.0]
    df = spark.createDataFrame([(0.25,), (0.35,), (None,)], "x double")
    assert values(df.select(num.half_even(F.col("x"), 1).alias("r")), "r") == [0.2, 0.4, None]


def test_clips_keep_missing_values(spark):
    df = spark.createDataFrame([(-1.0,), (50.0,), (200.0,), (None,)], "x double")
    assert values(df.select(num.at_least(F.col("x")).alias("r")), "r") == [0.0, 50.0, 200.0, None]
    assert values(df.select(num.clamp(F.col("x"), 2.0, 100.0).alias("r")), "r") == [2.0, 50.0, 100.0, None]


def test_box_rounding(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (4.9,), (5.0,), (12.0,), (12.5,), (17.5,)], "q double")
    boxed = df.select(num.box_round(F.col("q"), F.lit(5.0)).alias("r"))
    assert values(boxed, "r") == [0.0, 5.0, 5.0, 5.0, 10.0, 10.0, 20.0]


def test_ratios_never_divide_by_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (1.0, 4.0)], "a double, b double")
    assert values(df.select(num.safe_ratio(F.col("a"), F.col("b")).alias("r")), "r") == [0.0, 0.0, 0.25]


def test_bands_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(0.2,), (0.21,), (1.0,), (1.01,), (None,)], "e double")
    assert values(df.select(num.band_label(F.col("e")).alias("b")), "b") == ["pe20", "pe40", "pe100", "pe_more", None]
    flags = df.select(*(c.alias(n) for n, c in num.band_flags(F.col("e")).items())).collect()
    assert [sum(r) for r in flags] == [1, 1, 1, 1, 0]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert values(df.select(num.nan_to_null(F.col("x")).alias("r")), "r") == [None, 1.0]


def test_lags_count_rows_and_leave_out_the_current_one(spark):
    rows = [(1, days(0), 2.0), (1, days(5), 4.0), (1, days(6), 9.0)]
    df = win.lag_features(spark.createDataFrame(rows, "k int, ds date, y double"), ["k"], "ds", "y", (1, 2))
    out = {r["ds"]: r for r in df.collect()}
    first, second, third = (out[days(n)] for n in (0, 5, 6))
    assert first["lag_1_mean"] is None and first["lag_2_std"] is None
    assert second["lag_2_mean"] == 2.0 and second["lag_2_std"] is None
    assert third["lag_1_mean"] == 4.0 and third["lag_2_mean"] == 3.0 and third["lag_2_max"] == 4.0
    assert third["day_of_week"] == days(6).weekday()


def test_forward_sum_needs_all_its_rows(spark):
    rows = [(1, days(i), float(i + 1), 3) for i in range(5)] + [(2, days(i), 1.0, 0) for i in range(2)]
    df = spark.createDataFrame(rows, "k int, ds date, y double, n int")
    out = win.forward_sum_dynamic(df, ["k"], "ds", "y", {"s": F.col("n")})
    assert {(r["k"], r["ds"]): r["s"] for r in out.collect()} == {
        (1, days(0)): 6.0, (1, days(1)): 9.0, (1, days(2)): 12.0, (1, days(3)): 0.0, (1, days(4)): 0.0,
        (2, days(0)): 0.0, (2, days(1)): 0.0,
    }


def test_forward_sum_takes_the_length_from_the_first_row(spark):
    df = spark.createDataFrame([(1, days(0), 1.0, 2), (1, days(1), 2.0, 9), (1, days(2), 4.0, 9)], "k int, ds date, y double, n int")
    out = win.forward_sum_dynamic(df, ["k"], "ds", "y", {"s": F.col("n")}).orderBy("ds")
    assert values(out, "s") == [3.0, 6.0, 0.0]


def test_ties_of_the_best_model(spark):
    df = spark.createDataFrame([(1, "b", 0.9), (1, "a", 0.9), (1, "c", 0.1), (2, "c", None)], "k int, model string, acc double")
    assert sorted(values(win.best_rows(df.where("k = 1"), ["k"], "acc", "model", "all"), "model")) == ["a", "b"]
    assert {r["k"]: r["model"] for r in win.best_rows(df, ["k"], "acc", "model").collect()} == {1: "a", 2: "c"}


def test_previous_best_model(spark):
    rows = [(1, days(0), "a", 0.5), (1, days(0), "b", 0.7), (1, days(31), "a", 0.9), (1, days(31), "b", 0.7)]
    df = spark.createDataFrame(rows, "k int, dt date, model string, acc double")
    out = selection.previous_best_model(df, ["k"], "dt", "acc").orderBy("dt").collect()
    assert [r["best_model"] for r in out] == [None, "b"]


def test_ensemble_gives_no_weight_without_accuracy(spark):
    pred = spark.createDataFrame([(1, days(0), "a", 10.0), (1, days(0), "b", 20.0), (1, days(0), "c", 99.0)], "k int, predict_dt date, model string, p double")
    accuracy = spark.createDataFrame([(1, "a", 0.25), (1, "b", 0.75)], "k int, model string, acc double")
    assert values(selection.weighted_ensemble(pred, accuracy, ["k"], "acc", "p"), "p") == [17.5]


def test_densify_fills_gaps_and_sums_duplicates(spark):
    df = spark.createDataFrame([(1, days(0), 1.0), (1, days(0), 2.0), (1, days(2), 5.0)], "k int, ds date, y double")
    first, last = series.time_bounds(df, "ds")
    out = series.densify(df, ["k"], "ds", "y", first, last).orderBy("ds")
    assert values(out, "y") == [3.0, 0.0, 5.0]


def test_missing_keys_are_dropped(spark):
    df = spark.createDataFrame([(None, days(0), 1.0), (1, days(0), 2.0)], "k int, ds date, y double")
    assert values(series.daily_sum(df, ["k"], "ds", "y"), "y") == [2.0]


def test_bad_day_takes_the_following_day(spark):
    df = spark.createDataFrame([(1, days(0), 1.0), (1, days(1), 99.0), (1, days(2), 3.0)], "k int, ds date, y double")
    out = series.patch_bad_days(df, "ds", [str(days(1))]).orderBy("ds")
    assert values(out, "y") == [1.0, 3.0, 3.0]


def test_populations(spark):
    rows = [("norm", "norm_shop"), ("norm", "new_shop"), ("subnew", "norm_shop")]
    df = series.with_populations(spark.createDataFrame(rows, "type_flg string, shop_type_flg string"))
    counts = {r["data_label"]: r["count"] for r in df.groupBy("data_label").count().collect()}
    assert counts == {"all": 3, "normal": 1, "new_shop_normal": 1}


def test_positions_are_global(spark):
    rows = [(days(i % 3), i % 4, i) for i in range(40)]
    df = spark.createDataFrame(rows, "ds date, wh int, goods int")
    out = series.time_split(df, ["ds", "wh", "goods"], 0.8).collect()
    expected = {r: i + 1 for i, r in enumerate(sorted(rows))}
    assert {(r["ds"], r["wh"], r["goods"]): r["position"] for r in out} == expected
    assert sum(r["is_train"] for r in out) == 32


def test_constant_series_scales_to_zero(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (2, 1.0), (2, 3.0)], "k int, y double")
    out = series.minmax_scaled(df, ["k"], "y", "s").orderBy("k", "y")
    assert values(out, "s") == [0.0, 0.0, 0.0, 1.0]


def test_price_falls_back_to_goods_then_warehouse(spark):
    price = spark.createDataFrame([(1, 1, 2.0), (2, 1, 4.0), (1, 2, 10.0)], "wh_dept_id int, goods_id int, unit_price double")
    pairs = spark.createDataFrame([(1, 1), (3, 1), (2, 9), (3, 9)], "wh_dept_id int, goods_id int")
    out = {(r[0], r[1]): r[2] for r in acc.with_price(pairs, price).collect()}
    assert out == {(1, 1): 2.0, (3, 1): 3.0, (2, 9): 4.0, (3, 9): None}


def test_relative_error_with_zero_demand_uses_the_floor(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, p double")
    row = acc.accuracy_metrics(df.withColumn("k", F.lit(1)), ["k"], {"all": []}, "y", "p").collect()[0]
    assert row["MAE"] == 1.0 and row["MSE"] == 1.0 and row["MAPE"] > 1e15


def test_backtest_accuracy_is_floored(spark):
    df = spark.createDataFrame([(1.0, 5.0), (0.0, 5.0), (4.0, 5.0)], "y double, p double")
    out = acc.backtest_errors(df, "y", "p").collect()
    assert [(r["MAPE"], r["ACC"]) for r in out] == [(4.0, 0.0), (None, None), (0.25, 0.75)]


def test_lifecycle_later_rule_wins(spark):
    run = dt.date(2024, 6, 1)
    rows = [
        (1, run + dt.timedelta(5), None, None),
        (2, run - dt.timedelta(5), run - dt.timedelta(5), None),
        (3, run - dt.timedelta(90), run - dt.timedelta(90), None),
        (4, run + dt.timedelta(5), None, run - dt.timedelta(1)),
    ]
    plan = spark.createDataFrame(rows, "c int, launch_date date, sale_date date, actual_launch_date date")
    out = {r["c"]: r["cmdty_type"] for r in acc.lifecycle_class(plan, ["c"], str(run)).collect()}
    assert out == {1: "new", 2: "subnew", 3: "norm", 4: "subnew"}


def test_recursion_floors_only_at_the_end(spark):
    df = spark.createDataFrame([(1, days(0), -4.0), (1, days(1), -2.0)], "k int, ds date, y double")
    out = fc.recursive_mean(df, ["k"], "ds", "y", 3, window=2).orderBy("predict_dt")
    assert values(out, "pred") == [0.0, 0.0, 0.0]
    assert values(out, "predict_dt") == [days(2), days(3), days(4)]


def test_contract_casts_rounds_and_wants_every_column(spark):
    df = spark.createDataFrame([("7", 1.25, "2024-01-01"), (None, None, None)], "goods_id string, q double, dt string")
    contract = {"goods_id": "bigint", "q": "double:1", "dt": "date"}
    assert [tuple(r) for r in sinks.apply_contract(df, contract).collect()] == [(7, 1.2, days(0)), (None, None, None)]
    with pytest.raises(Exception, match="absent"):
        sinks.apply_contract(df, {"absent": "int"}).collect()


def test_contract_reports_values_that_do_not_fit(spark):
    df = spark.createDataFrame([("x",)], "dt string")
    with pytest.raises(Exception, match="dt does not fit date: x"):
        sinks.apply_contract(df, {"dt": "date"}).collect()


def test_errors_keep_small_differences(spark):
    df = spark.createDataFrame([(1, 0.0, 0.04), (1, 1.0, 1.03)], "k int, y double, p double")
    row = acc.accuracy_metrics(df, ["k"], {"all": []}, "y", "p").collect()[0]
    assert (row["MAE"], row["MSE"]) == (0.035, 0.0012)


def test_any_negative_forecast_counts(spark):
    df = spark.createDataFrame([(1, "m", -1e-9), (2, "m", 0.0)], "k int, model string, p double")
    assert values(selection.negative_forecasts(df, ["k"], "p"), "k") == [1]


def test_series_are_dense_from_their_first_day(spark):
    df = spark.createDataFrame([(1, days(0), 2.0), (1, days(3), 1.0), (2, days(2), 5.0)], "k int, ds date, y double")
    out = {(r["k"], r["ds"]): r["y"] for r in series.dense_from_first(df, ["k"], "ds", "y").collect()}
    assert out == {(1, days(0)): 2.0, (1, days(1)): 0.0, (1, days(2)): 0.0, (1, days(3)): 1.0, (2, days(2)): 5.0, (2, days(3)): 0.0}


def test_dense_from_first_fills_where_the_rows_lie(spark):
    rows = [(f"k{k}", days(k % 5), float(k)) for k in range(30)] + [("k3", days(3), 4.0), ("k3", days(6), None), (None, days(0), 9.0), ("k4", days(99), 1.0)]
    dense = series.dense_from_first(spark.createDataFrame(rows, "k string, ds date, y double"), ["k"], "ds", "y")
    placed = dense.withColumn("task", F.spark_partition_id()).collect()
    want = {(f"k{k}", days(d)): float(k) * (d == k % 5) for k in range(30) for d in range(k % 5, 100)} | {("k3", days(3)): 7.0, ("k4", days(99)): 1.0}
    assert len(placed) == len(want) and {(r["k"], r["ds"]): r["y"] for r in placed} == want
    # However small the rows before the fill are, no task gets the calendars of all keys.
    assert len({r["task"] for r in placed}) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_series_take_more_partitions_the_more_there_are(spark):
    rows = [(k, days(d), 1.0) for k in range(40) for d in (k % 5, 99)] + [(None, days(0), 1.0), (1, None, 1.0)]
    df = spark.createDataFrame(rows, "k int, ds date, y double")
    assert series.series_partitions(df, ["k"], "ds", 50) == -(-sum(100 - k % 5 for k in range(40)) // 50)
    assert series.series_partitions(df.limit(0), ["k"], "ds", 50) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    dense = series.dense_from_first(df, ["k"], "ds", "y", partitions=7)
    assert dense.rdd.getNumPartitions() == 7 and dense.count() == sum(100 - k % 5 for k in range(40))


def test_sold_rows_are_joined_in_more_partitions_the_more_there_are(spark, tmp_path, monkeypatch):
    parts = [(k, 1 + k, "b", "t") for k in [*range(40), 7]] + [(None, 1, "b", "t")]
    lines = [(k, 1, dt.datetime(1996, 1, 1 + d), 2.0, 20.0, 0.0, "N", 1) for k in [*range(40), None] for d in range(10)]
    spark.createDataFrame(parts, "p_partkey long, p_size int, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    schema = "l_partkey long, l_suppkey long, l_shipdate timestamp, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linenumber int"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    whole = sorted(Inputs(spark, str(tmp_path)).sold_rows.collect())
    assert len(whole) == 410
    monkeypatch.setattr(series, "PARTITION_ROWS", 40)
    assert sorted(Inputs(spark, str(tmp_path)).sold_rows.collect()) == whole
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = Inputs(spark, str(tmp_path)).sold_rows
        # 410 lines in partitions of 40.
        assert moved.rdd.getNumPartitions() == 11 and sorted(moved.collect()) == whole
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_forecasts_meet_demand_in_as_many_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(series, "series_partitions", lambda *_: 11)
    parts = [(k, 1 + k % 50, "b", "t") for k in range(1, 40)]
    lines = [(k, k, dt.datetime(1996, 1 + d % 12, 1 + d % 28), 2.0, 20.0, 0.0, "N", 1) for k in range(1, 40) for d in range(60)]
    spark.createDataFrame(parts, "p_partkey long, p_size int, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    schema = "l_partkey long, l_suppkey long, l_shipdate timestamp, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linenumber int"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = Inputs(spark, str(tmp_path)).evaluated
    assert found.count() > 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert len(moved) == 3 and all(", 11), REPARTITION_BY_NUM" in line for line in moved) and "SortMergeJoin" in plan


def test_sold_rows_are_summed_in_more_partitions_the_more_there_are(spark, tmp_path, monkeypatch):
    parts = [(k, 1 + k, "b", "t") for k in [*range(40), 7]]
    lines = [(k, k, dt.datetime(1996, 1, 1 + d), 2.0, 20.0, 0.0, "N", 1) for k in [*range(40), None] for d in range(10)]
    lines += [(3, 3, dt.datetime(1996, 1, 1), 5.0, 50.0, 0.0, "N", 2)] * 30 + [(3, 3, None, 1.0, 1.0, 0.0, "N", 1), (3, None, dt.datetime(1996, 1, 1), 1.0, 1.0, 0.0, "N", 1)]
    lines += [(3, 3, dt.datetime(1996, 2, 1), None, None, 0.0, "N", 1)]
    spark.createDataFrame(parts, "p_partkey long, p_size int, p_brand string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    schema = "l_partkey long, l_suppkey long, l_shipdate timestamp, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linenumber int"
    spark.createDataFrame(lines, schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    whole = sorted(Inputs(spark, str(tmp_path)).daily_demand.collect(), key=str)
    assert len(whole) == 401 and sum(r["y"] or 0 for r in whole) == 2 * 410 + 5 * 30
    monkeypatch.setattr(series, "PARTITION_ROWS", 40)
    dealt = Inputs(spark, str(tmp_path)).daily_demand
    assert sorted(dealt.collect(), key=str) == whole
    # 443 lines in partitions of 40, dealt by key and day before anything is summed and only once.
    plan = dealt._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(wh_dept_id" in line]
    assert dealt.rdd.getNumPartitions() == 12 and len(moved) == 1 and ", 12), REPARTITION_BY_NUM" in moved[0]
    assert plan.rindex("HashAggregate") < plan.index(moved[0])


def test_recursion_uses_the_whole_window(spark):
    df = spark.createDataFrame([(1, days(i), float(i)) for i in range(200)], "k int, ds date, y double")
    assert values(fc.recursive_mean(df, ["k"], "ds", "y", 1, window=180), "pred") == [109.5]


def test_shared_folder_must_be_set():
    unset = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(unset)


def test_nan_counts_as_missing(spark, tmp_path):
    path = str(tmp_path / "nan")
    spark.createDataFrame([(1, float("nan")), (2, 1.0)], "k int, v double").write.parquet(path)
    assert sorted(values(readers.read_file(spark, path), "v"), key=str) == [1.0, None]


def test_only_a_missing_path_is_computed(spark, tmp_path):
    path = tmp_path / "not-parquet"
    path.mkdir()
    (path / "part-0.parquet").write_text("text")
    with pytest.raises(Exception):
        readers.read_or_compute(spark, str(path), lambda: spark.range(3)).collect()
    assert (path / "part-0.parquet").read_text() == "text"


def test_writes_replace_only_their_days(spark, tmp_path):
    path = str(tmp_path / "mart")
    df = spark.createDataFrame([(days(0), 1), (days(1), 2)], "dt date, v int")
    sinks.write_days(df, path)
    sinks.write_days(df.where(F.col("v") == 2).withColumn("v", F.lit(20)), path)
    assert {r["dt"]: r["v"] for r in readers.read_days(spark, path).collect()} == {days(0): 1, days(1): 20}
    assert values(readers.read_days(spark, path, str(days(1))), "v") == [20]


def test_day_filter_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "mart")
    sinks.write_days(spark.createDataFrame([(days(i), i) for i in range(5)], "dt date, v int"), path)
    plan = readers.read_days(spark, path, str(days(1)), str(days(2)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_tables_replace_only_their_days(spark):
    df = spark.createDataFrame([(1, days(0)), (2, days(1))], "v int, dt date")
    sinks.write_table(df, "mart_days")
    sinks.write_table(df.where(F.col("v") == 2).withColumn("v", F.lit(20)), "mart_days")
    assert {r["dt"]: r["v"] for r in spark.table("mart_days").collect()} == {days(0): 1, days(1): 20}


def test_fallback_when_the_run_day_is_empty(spark):
    df = spark.createDataFrame([(days(0), 1), (days(1), 2), (days(9), 3)], "dt date, v int")
    assert values(readers.latest_available(df, str(days(5))), "v") == [2]
    assert values(readers.latest_available(df, str(days(9))), "v") == [3]


def test_computed_rows_are_stored_once(spark, tmp_path):
    calls = []

    def compute():
        calls.append(1)
        return spark.range(3)

    path = str(tmp_path / "cached")
    assert readers.read_or_compute(spark, path, compute).count() == 3
    assert readers.read_or_compute(spark, path, compute).count() == 3
    assert len(calls) == 1


def test_quality_check_raises_on_bad_and_on_empty_tables(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,)], "q double")
    rules = {"negative": F.col("q") < 0}
    with pytest.raises(quality.InvalidDataError, match="negative"):
        quality.require_valid(df, rules)
    with pytest.raises(quality.InvalidDataError):
        quality.require_valid(df.where("q > 5"), rules)
    good = df.where("q > 0")
    assert quality.require_valid(good, rules) is good


def test_row_counts_of_neighbouring_days(spark):
    df = spark.createDataFrame([(days(0),)] * 10 + [(days(1),)] * 5 + [(days(2),)] * 10, "ds date")
    out = quality.row_count_ratio(df, "ds").orderBy("ds").collect()
    assert [(r["ratio"], r["state"]) for r in out] == [(0.5, "low"), (2.0, "high")]


@pytest.mark.parametrize("whole", [True, False])
def test_lag_features_equal_frames(spark, whole):
    """Running sums and sparse tables against the frames they stand for."""
    r = random.Random(5)
    rows = []
    for key in range(4):
        for d in range(150):
            y = None if r.random() < 0.1 else float(r.randint(0, 60)) if whole else r.random() * 1e5
            rows.append((key, d, 7.0 if key == 3 and d > 20 and y is not None else y))
    df = spark.createDataFrame(rows, "k int, t int, y double")
    got = {(r.k, r.t): r.asDict() for r in win.lag_features(df, ["k"], "t", "y", (1, 2, 7, 28, 64, 120), False).collect()}
    values = {k: [y for _, _, y in sorted(x for x in rows if x[0] == k)] for k in range(4)}
    for key, t, _ in rows:
        for w in (1, 2, 7, 28, 64, 120):
            held = [v for v in values[key][max(0, t - w) : t] if v is not None]
            want = {"mean": sum(held) / len(held) if held else None}
            if w > 1:
                want |= {"min": min(held, default=None), "max": max(held, default=None), "std": statistics.stdev(held) if len(held) > 1 else None}
            for name, v in want.items():
                found = got[key, t][f"lag_{w}_{name}"]
                assert (found is None) == (v is None), (key, t, w, name)
                assert v is None or found == pytest.approx(v, rel=1e-9, abs=1e-9), (key, t, w, name)
