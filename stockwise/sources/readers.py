"""Reads of day-partitioned datasets, files and snapshots."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockwise.functions.numeric import nan_to_null
from stockwise.operators.windows import last_rows


def read_days(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of one day or of ``[start, end]``; the filter on ``dt`` prunes partitions.

    Without dates every partition is read.  NaN counts as missing.
    """
    df = without_nan(spark.read.option("basePath", path).parquet(path))
    if start is None:
        return df
    return df.where(F.col("dt").between(F.lit(start).cast("date"), F.lit(end or start).cast("date")))


def read_latest_per_key(spark: SparkSession, path: str, keys: Sequence[str], *ties: str) -> DataFrame:
    """The last day's row of every key over all partitions."""
    return last_rows(read_days(spark, path), keys, "dt", *ties)


def read_file(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """One Parquet or CSV folder; CSV carries a header and needs its schema."""
    if schema is None:
        return without_nan(spark.read.parquet(path))
    return without_nan(spark.read.csv(path, header=True, schema=schema))


def without_nan(df: DataFrame) -> DataFrame:
    """NaN counts as missing in all float columns."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")]
    return df.withColumns({name: nan_to_null(F.col(name)) for name in floats}) if floats else df


def latest_snapshot(df: DataFrame, day: str) -> DataFrame:
    """Rows of the last hour-minute snapshot of a day."""
    of_day = df.where(F.col("dt") == F.lit(day).cast("date"))
    newest = of_day.select(F.max("hm")).scalar()
    return of_day.where(F.col("hm") == newest)


def latest_available(df: DataFrame, run_day: str) -> DataFrame:
    """Rows of the run day, or of the last earlier day that has any."""
    until = df.where(F.col("dt") <= F.lit(run_day).cast("date"))
    newest = until.select(F.max("dt")).scalar()
    return df.where(F.col("dt") == newest)


def read_or_compute(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """Rows stored under ``path``; computed and stored first where there are none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        # Any other failure (schema, permission) must not lead to stored rows being replaced.
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    compute().write.parquet(path)
    return spark.read.parquet(path)
