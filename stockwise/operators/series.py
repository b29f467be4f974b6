"""Preparing keyed daily series: populations, sums, repairs, dense calendars, splits, scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockwise.functions.dates import first_of
from stockwise.operators.windows import by
from stockwise.session import staged


def daily_sum(df: DataFrame, keys: Sequence[str], time: str, value: str, out: str = "y") -> DataFrame:
    """One row per key and day; a group key may not be missing."""
    return present(df, *keys, time).groupBy(*keys, time).agg(F.sum(value).alias(out))


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows that have all the columns.

    Stated at the source, the condition makes the branches of a plan alike whatever later joins
    infer from it, so that they share one scan and one exchange.
    """
    condition = F.col(columns[0]).isNotNull()
    for name in columns[1:]:
        condition = condition & F.col(name).isNotNull()
    return df.where(condition)


# Which (type, shop type) rows belong to a population; None takes every row.
POPULATIONS = {
    "normal": ("norm", "norm_shop"),
    "new_shop_normal": ("norm", "new_shop"),
    "all": None,
}


def population(df: DataFrame, label: str) -> DataFrame:
    """Rows of one population."""
    wanted = POPULATIONS[label]
    if wanted is None:
        return df
    type_flg, shop_flg = wanted
    return df.where((F.col("type_flg") == type_flg) & (F.col("shop_type_flg") == shop_flg))


def with_populations(df: DataFrame) -> DataFrame:
    """Every row once per population it belongs to, the population as a column."""
    labels = [
        F.lit(label) if wanted is None
        else F.when((F.col("type_flg") == wanted[0]) & (F.col("shop_type_flg") == wanted[1]), label)
        for label, wanted in POPULATIONS.items()
    ]
    return df.withColumn("data_label", F.explode(F.array_compact(F.array(*labels))))


def demand_series(df: DataFrame, keys: Sequence[str], time: str, value: str, grain: str = "day") -> DataFrame:
    """Demand as ``(ds, keys, y)`` per day, week or month; amounts count by size, not by sign."""
    day = F.to_date(time)
    ds = day if grain == "day" else first_of(grain, day)
    rows = df.select(ds.alias("ds"), *keys, F.abs(F.col(value).cast("double")).alias("y"))
    return daily_sum(rows, keys, "ds", "y")


def patch_bad_days(df: DataFrame, time: str, bad_days: Sequence[str]) -> DataFrame:
    """Replace each bad day by a copy of the following day."""
    bad = [F.lit(d).cast("date") for d in bad_days]
    kept = df.where(~F.col(time).isin(*bad))
    copies = df.withColumn(time, F.date_sub(F.col(time), 1)).where(F.col(time).isin(*bad))
    return kept.unionByName(copies.select(*kept.columns))


def time_bounds(df: DataFrame, time: str) -> tuple[Column, Column]:
    """First and last day as one scalar subquery."""
    bounds = df.select(F.struct(F.min(time).alias("first"), F.max(time).alias("last"))).scalar()
    return bounds["first"], bounds["last"]


def calendar(df: DataFrame, keys: Sequence[str], first: Column, last: Column, time: str = "ds") -> DataFrame:
    """Every key with every day between the two dates."""
    return df.select(*keys).distinct().withColumn(time, F.explode(F.sequence(first, last)))


def densify(
    df: DataFrame, keys: Sequence[str], time: str, value: str, first: Column, last: Column, fill: float = 0.0
) -> DataFrame:
    """One row per key and day, gaps filled.

    The fill rows join the aggregation as a union, which needs no join and stays even on hot keys.
    """
    empty = calendar(df, keys, first, last, time).withColumn(value, F.lit(fill))
    return daily_sum(df.select(*keys, time, value).unionByName(empty), keys, time, value, value)


#: Days of calendars that lie in one partition of series (fixed value).
PARTITION_DAYS = 250_000


def series_partitions(df: DataFrame, keys: Sequence[str], time: str, days: int = PARTITION_DAYS) -> int:
    """The number of partitions over which dense series are spread, so that the share of a task does not grow with their number.

    Counted are the days from each key's first day to the last day of all.  ``df`` is read for it, so it should be a table.
    """
    day = F.unix_date(time).cast("long")
    starts = present(df, *keys, time).groupBy(*keys).agg(F.min(day).alias("first"), F.max(day).alias("last"))
    total = starts.agg(F.count("*") * (F.max("last") + 1) - F.sum("first")).collect()[0][0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // days))


#: Rows of a raw table that lie in one partition where a join sorts them or a sum keeps their keys (fixed value).
PARTITION_ROWS = 1_000_000


def dealt_by(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """The rows of a raw table of so many rows, dealt by key, so that a sum by these keys (and further ones) needs no other shuffle.

    A sum where the rows lie keeps the keys of a whole file split in one task, and where keys are nearly as many as rows it takes little
    off what is shuffled; what is left then meets in a fixed number of partitions.  Dealt over partitions whose number grows with the
    rows, a task keeps the keys of its share only, however the files are cut, and the rows of one key pass it one by one.  A table that
    fits one partition is summed where it lies.
    """
    if rows <= PARTITION_ROWS:
        return df
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // PARTITION_ROWS)), *keys)


def spread_for(table: DataFrame, key: str, rows: int) -> DataFrame:
    """``table`` as the smaller side of a join on ``key`` with a raw table of so many rows.

    A join that moves both sides does so in a fixed number of partitions, whose tasks would hold more rows, sorted and summed, with every
    further row.  The smaller side states the number instead and the raw side follows; where the smaller side is broadcast, the raw
    rows stay where they are.
    """
    partitions = -(-rows // PARTITION_ROWS)
    if partitions <= int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return table
    return table.repartition(partitions, key)


def dense_from_first(
    df: DataFrame, keys: Sequence[str], time: str, value: str, fill: float = 0.0, partitions: int | None = None
) -> DataFrame:
    """One row per key and day from the key's first day to the last day of all, gaps filled.

    A forecast origin then has its row for every key that has started, whether it sold on that day or not.

    Every row is followed by the days up to the key's next row, so the filled days arise where the key's rows already lie, in one shuffle
    and without a second aggregation of the whole calendar.  The number of partitions is stated: sized by the rows before the fill, one
    task could get the calendars of all keys; a fixed number would give each task more days with every key.  ``df`` is read more
    than once and should be a table.
    """
    last = df.select(F.max(time)).scalar()
    partitions = partitions or series_partitions(df, keys, time)
    rows = present(df.select(*keys, time, value), *keys, time).repartition(partitions, *keys)
    # A day that comes more than once counts with its sum; the last of its rows carries it.
    rows = rows.withColumns({"_sum": F.sum(value).over(by([*keys, time])), "_next": F.lead(time).over(by(keys, time))})
    rows = rows.where(F.col("_next").isNull() | (F.col("_next") > F.col(time)))
    until = F.coalesce(F.date_sub("_next", 1), last)
    days = rows.select(*keys, F.col(time).alias("_day"), "_sum", F.explode(F.sequence(time, until)).alias(time))
    own = F.when(F.col(time) == F.col("_day"), F.coalesce(F.col("_sum"), F.lit(0.0))).otherwise(F.lit(0.0))
    return days.select(*keys, time, (own + F.lit(fill)).alias(value))


def month_ends(first: Column, last: Column) -> Column:
    """Last days of all months between two dates."""
    months = F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))
    return F.transform(months, F.last_day)


def previous_month_starts(day: Column, n: int) -> Column:
    """First days of the ``n`` months before the month of ``day``."""
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.add_months(F.trunc(day, "month"), -k))


def positional_rank(df: DataFrame, levels: Sequence[str], out: str = "position", ranges: int | None = None) -> DataFrame:
    """Row number of every row in the order of ``levels``, without gathering the table or a prefix of it in one task.

    The rows are dealt to ranges of near-equal size, whose bounds Spark samples from all levels together, so a value of the first
    level may fill many ranges.  Counts per range give the numbers before each, and rows are numbered inside their range.
    """
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = staged(df.repartitionByRange(ranges, *levels).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = by([], "_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = counts.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    numbered = ranged.withColumn("_rank", F.row_number().over(by(["_range"], *levels)).cast("long")).join(offsets, "_range")
    return numbered.select(*df.columns, (F.col("_rank") + F.col("_before")).alias(out))


def time_split(df: DataFrame, levels: Sequence[str], ratio: float) -> DataFrame:
    """Mark the first ``floor(rows * ratio)`` rows in the order of ``levels`` as training rows."""
    cut = df.select(F.floor(F.count("*") * F.lit(ratio))).scalar()
    return positional_rank(df, levels).withColumn("is_train", (F.col("position") <= cut).cast("long"))


def complete_keys(df: DataFrame, keys: Sequence[str], days: Column) -> DataFrame:
    """Keys whose history has a row for each of ``days`` days."""
    full = df.groupBy(*keys).agg(F.count("*").alias("_days")).where(F.col("_days") == days)
    return df.join(full.select(*keys), list(keys), "left_semi")


def minmax_scaled(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Series scaled to [0, 1] per key; a constant series becomes 0."""
    spec = by(keys)
    low, high = F.min(value).over(spec), F.max(value).over(spec)
    return df.withColumn(out, F.coalesce(F.try_divide(F.col(value) - low, high - low), F.lit(0.0)))
