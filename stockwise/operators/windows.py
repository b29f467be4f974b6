"""Window operators over keyed series.

Every series is summed to one row per key and day before it gets here, so that a window
partition holds at most the days of the calendar, however many raw rows a key has.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from stockwise.functions.dates import date_parts

# Lag windows per calendar grain.
DAY_WINDOWS = (1, 7, 14, 21, 28, 30, 60, 120)
WEEK_WINDOWS = (2, 4, 6, 8, 12, 16, 24)
MONTH_WINDOWS = (2, 3, 4, 6, 8, 12)


def by(keys: Sequence[str], *order: str | Column) -> WindowSpec:
    spec = Window.partitionBy(*keys)
    return spec.orderBy(*order) if order else spec


def lag_features(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    windows: Iterable[int] = DAY_WINDOWS,
    with_date_parts: bool = True,
) -> DataFrame:
    """Mean, deviation, minimum and maximum of the last ``w`` rows before the current one.

    The frames count rows, not days.  A one-row window yields its mean only.

    The cost per row does not grow with the windows' lengths but with the number of their binary digits: count, sum, squared
    distance from the mean, minimum and maximum are known for stretches of 1, 2, 4, ... rows, each joined from two of
    the one before, and a window is put together from a few of them.  All of it reads other rows at fixed distances in one order of the
    series, so there is one shuffle and one sort.  Sums of whole amounts are exact, and squared distances are joined by their
    means, without differences of large numbers.
    """
    windows = list(windows)
    spec = by(keys, time)
    known = F.col(value).isNotNull()
    table = df.withColumns(
        {
            "_n0": known.cast("double"), "_s0": F.when(known, F.col(value)).otherwise(0.0), "_m0": F.lit(0.0),
            "_low0": F.col(value), "_high0": F.col(value),
        }
    )
    levels = max(w.bit_length() - 1 for w in windows)
    for k in range(1, levels + 1):
        before = {c: F.lag(f"_{c}{k - 1}", 1 << (k - 1)).over(spec) for c in ("n", "s", "m", "low", "high")}
        table = table.withColumns({f"_b{c}": col for c, col in before.items()})
        table = table.withColumns(
            {
                **{f"_{c}{k}": col for c, col in _joined_spread(str(k - 1), "_b{}").items()},
                f"_low{k}": F.least(f"_low{k - 1}", "_blow"),
                f"_high{k}": F.greatest(f"_high{k - 1}", "_bhigh"),
            }
        )

    # The parts of every window, from the newest rows on.
    lags, parts = {}, {}
    for w in windows:
        top, offset = w.bit_length() - 1, 1
        parts[w] = 0
        for k in range(top, -1, -1):
            if w >> k & 1:
                lags |= {f"_{c}_{w}_{parts[w]}": F.lag(f"_{c}{k}", offset).over(spec) for c in ("n", "s", "m")}
                parts[w], offset = parts[w] + 1, offset + (1 << k)
        if w > 1:
            for c, pick in (("low", F.least), ("high", F.greatest)):
                # Two stretches that may overlap.
                lags[f"_{c}_{w}"] = pick(F.lag(f"_{c}{top}", 1).over(spec), F.lag(f"_{c}{top}", w - (1 << top) + 1).over(spec))
    table = table.withColumns(lags)
    for k in range(1, max(parts.values())):
        table = table.withColumns(
            {
                f"_{c}_{w}_0": col
                for w in windows
                if k < parts[w]
                for c, col in _joined_spread(f"_{w}_0", "_{}" + f"_{w}_{k}").items()
            }
        )
    columns: dict[str, Column] = date_parts(F.col(time)) if with_date_parts else {}
    for w in windows:
        n = F.col(f"_n_{w}_0")
        columns[f"lag_{w}_mean"] = F.try_divide(F.col(f"_s_{w}_0"), n)
        if w > 1:
            columns[f"lag_{w}_std"] = F.sqrt(F.try_divide(F.when(n > 1, F.col(f"_m_{w}_0")), n - 1))
            columns[f"lag_{w}_min"] = F.col(f"_low_{w}")
            columns[f"lag_{w}_max"] = F.col(f"_high_{w}")
    return table.withColumns(columns).select(*df.columns, *columns)


def _joined_spread(first: str, second: str) -> dict[str, Column]:
    """Count, sum and squared distance from the mean of two stretches together; the second may be missing."""
    n1, s1, m1 = (F.col(f"_{c}{first}") for c in ("n", "s", "m"))
    n2, s2, m2 = (F.coalesce(F.col(second.format(c)), F.lit(0.0)) for c in ("n", "s", "m"))
    apart = F.try_divide(s1, n1) - F.try_divide(s2, n2)
    between = F.coalesce(apart * apart * F.try_divide(n1 * n2, n1 + n2), F.lit(0.0))
    return {"n": n1 + n2, "s": s1 + s2, "m": m1 + m2 + between}


def trailing_means(df: DataFrame, keys: Sequence[str], time: str, value: str, windows: Iterable[int]) -> DataFrame:
    """Only the lagged means, for the flat baselines."""
    spec = by(keys, time)
    return df.withColumns({f"lag_{w}_mean": F.avg(value).over(spec.rowsBetween(-w, -1)) for w in windows})


def newest_slice(df: DataFrame, time: str) -> DataFrame:
    """Rows of the last day present; applied after the windows, never before them."""
    newest = df.select(F.max(time)).scalar()
    return df.where(F.col(time) == newest)


def forward_mean(df: DataFrame, keys: Sequence[str], time: str, value: str, n: int, out: str) -> DataFrame:
    """Mean of the current and the next ``n - 1`` rows, shorter at the end."""
    return df.withColumn(out, F.avg(value).over(by(keys, time).rowsBetween(0, n - 1)))


def forward_sums(df: DataFrame, keys: Sequence[str], time: str, value: str, sums: Mapping[str, int]) -> DataFrame:
    """Forward sums of fixed length; ``sums`` maps the target column to the number of rows."""
    spec = by(keys, time)
    return df.withColumns({out: F.sum(value).over(spec.rowsBetween(0, n - 1)) for out, n in sums.items()})


def forward_sum_dynamic(df: DataFrame, keys: Sequence[str], time: str, value: str, sums: Mapping[str, Column]) -> DataFrame:
    """Forward sums whose length is a column, taken from the first row of each key.

    Row ``i`` gets the sum of rows ``i .. i+n-1`` and 0 where fewer than ``n`` rows remain.  The
    running total of a key, at most one calendar long, is gathered into one array in which every
    row looks up its end.
    """
    rest = [c for c in df.columns if c not in keys and c != time]
    staged = df.withColumns({f"_n_{out}": n.cast("int") for out, n in sums.items()})
    running = F.sum(F.coalesce(F.col(value), F.lit(0.0))).over(by(keys, time).rowsBetween(Window.unboundedPreceding, 0))
    row = F.struct(time, *rest, *(f"_n_{out}" for out in sums), "_sum")
    gathered = staged.withColumn("_sum", running).groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("_rows"))

    def looked_up(r: Column, i: Column) -> Column:
        before = r["_sum"] - F.coalesce(r[value], F.lit(0.0))

        def forward(out: str) -> Column:
            n = F.get("_rows", F.lit(0))[f"_n_{out}"]
            inside = (n > 0) & (i + n <= F.size("_rows"))
            return F.when(inside, F.get("_rows", i + n - 1)["_sum"] - before).otherwise(F.lit(0.0)).alias(out)

        return F.struct(*(r[c].alias(c) for c in (time, *rest)), *(forward(out) for out in sums))

    return gathered.select(*keys, F.inline(F.transform("_rows", looked_up))).select(*df.columns, *sums)


def running_total(df: DataFrame, keys: Sequence[str], time: str, value: str, out: str) -> DataFrame:
    return df.withColumn(out, F.sum(value).over(by(keys, time).rowsBetween(Window.unboundedPreceding, 0)))


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key.  The rank filter is applied on the map side before the shuffle."""
    return df.withColumn("_rank", F.row_number().over(by(keys, *order))).where(F.col("_rank") <= n).drop("_rank")


def last_rows(df: DataFrame, keys: Sequence[str], time: str, *ties: str, n: int = 1) -> DataFrame:
    """Last ``n`` rows per key in time order; ``ties`` settle equal times."""
    return top_rows(df, keys, [F.desc(time), *(F.desc(t) for t in ties)], n)


def best_rows(df: DataFrame, keys: Sequence[str], score: str, label: str, ties: str = "first") -> DataFrame:
    """Rows with the highest score per key: all of them, or the first label among equals."""
    if ties == "all":
        ranked = df.withColumn("_rank", F.rank().over(by(keys, F.desc_nulls_last(score))))
        return ranked.where(F.col("_rank") == 1).drop("_rank")
    return top_rows(df, keys, [F.desc_nulls_last(score), F.asc(label)])


def previous_value(df: DataFrame, keys: Sequence[str], time: str, value: str, out: str) -> DataFrame:
    return df.withColumn(out, F.lag(value, 1).over(by(keys, time)))


def share_of_total(df: DataFrame, keys: Sequence[str], value: str, total: str, share: str) -> DataFrame:
    """Group total on every row and the row's share of it.

    The total is aggregated (combined on the map side) and joined back, so that a hot group is
    never gathered in one window partition.
    """
    totals = df.groupBy(*keys).agg(F.sum(value).alias(total))
    return df.join(totals, list(keys)).withColumn(share, F.try_divide(F.col(value), F.col(total)))
