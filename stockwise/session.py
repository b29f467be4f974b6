"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", app: str = "stockwise", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "localhost")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder.rstrip("/")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Has the file system delete what was written under ``path`` when the driver ends."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of executors, the plan starts anew."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def staged(df: DataFrame, label: str) -> DataFrame:
    """An intermediate that several branches of a plan read, written once to the shared folder.

    The branches then scan a small table with their own columns instead of each going back to the
    raw rows, and the table's real size decides how it is joined.
    """
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    remove_at_exit(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
