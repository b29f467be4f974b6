"""Typed writes into day-partitioned datasets and tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from stockwise.functions.numeric import half_even

# Fixed values.  Contracts: output column -> type, with the digits kept for rounded doubles after a colon.
FORECAST = {
    "predict_dt": "string", "wh_dept_id": "bigint", "goods_id": "bigint", "model": "string",
    "predict_demand": "double:1", "dt": "date",
}
RECENT_PRODUCT = {
    "goods_id": "int", "material_type": "int", "stock_up_version": "int", "consumer_version": "int",
    "strategy_version_id": "int", "sim_version": "int", "stock_quantity": "double", "stock_days": "int",
    "cg_trs_quantity": "double", "cg_trs_days": "int", "po_quantity": "double", "po_days": "int",
    "replenish_quantity": "double", "replenish_days": "int", "total_days": "int", "w1": "double", "w2": "double",
    "w3": "double", "w4": "double", "stock_deadline": "string", "cg_trs_deadline": "string",
    "po_deadline": "string", "replenish_deadline": "string",
}
NEW_PRODUCT = {
    "goods_id": "int", "material_type": "int", "stock_up_version": "int", "consumer_version": "int",
    "strategy_version_id": "int", "sim_version": "int", "first_delivery_quantity": "double",
    "first_delivery_days": "int", "goods_stock_up_quantity": "double", "goods_stock_up_days": "int",
    "raw_stock_quantity": "double", "raw_stock_days": "int", "total_days": "int", "w1": "double", "w2": "double",
    "w3": "double", "w4": "double", "first_deadline": "string", "goods_deadline": "string", "raw_deadline": "string",
    "plan_sale_duration": "int", "over_plan_quantity": "double", "is_expire_risk": "int",
    "estimated_expired_quantity": "double",
}
AVAILABILITY = {
    "predict_dt": "string", "goods_id": "int", "material_type": "int", "scene": "int", "stock_up_version": "int",
    "consumer_version": "int", "strategy_version_id": "int", "sim_version": "int", "shop_avl_rate": "double",
    "wh_avl_days": "int", "shop_avl_days": "int", "dly_use_ratio": "double", "pur_use_ratio": "double",
    "is_min_launch_day": "int", "shop_consume_amount": "double", "wh_consume_amount": "double",
}


def apply_contract(df: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Project, order, round and cast to the contract's columns; days become text as yyyy-MM-dd.

    A column the frame lacks is an error, and so is a value that does not fit its type; NULL stays NULL.
    """
    columns = []
    for name, spec in contract.items():
        kind, _, digits = spec.partition(":")
        cast = F.col(name).try_cast(kind)
        misfit = F.raise_error(F.concat(F.lit(f"{name} does not fit {kind}: "), F.col(name).cast("string")))
        value = F.when(F.col(name).isNotNull() & cast.isNull(), misfit).otherwise(cast)
        columns.append((half_even(value, int(digits)) if digits else value).alias(name))
    return df.select(*columns)


def write_days(df: DataFrame, path: str, day: str = "dt") -> None:
    """Replace the days present in ``df`` and leave all other days of the dataset alone.

    The rebalance brings the rows of a day together for few files, and adaptive execution
    splits a day that is far larger than the rest.
    """
    (
        df.hint("rebalance", day)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )


def write_table(df: DataFrame, table: str, day: str = "dt") -> None:
    """Replace the days present in ``df`` in a partitioned Parquet table, creating it at first."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.hint("rebalance", day).write.partitionBy(day).format("parquet").saveAsTable(table)
        return
    # An insert overwrites single days only under a session setting, which other threads would see; the writer of
    # the table's folder has an option for it, and the catalog then learns of new days.
    location = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]
    write_days(df.select(*spark.table(table).columns), location, day)
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def backfill(df: DataFrame, path: str, time: str, cutoff: str) -> None:
    """Write every day from ``cutoff`` on in one job, each into its own partition."""
    write_days(df.where(F.col(time) >= F.lit(cutoff).cast("date")).withColumn("dt", F.col(time)), path)
