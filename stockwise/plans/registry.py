"""Query registry: every entry pairs a Spark job with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockwise.plans.inputs import Inputs

_JOBS: dict[str, Callable[[Inputs], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn(inputs) -> DataFrame`` under ``name``, with its SQL when there is one."""

    def register(fn: Callable[[Inputs], DataFrame]):
        if name in _JOBS:
            raise ValueError(f"query {name} registered twice")
        _JOBS[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return register


def _callable(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(spark, sf_dir))

    return run


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _callable(fn) for name, fn in _JOBS.items()}


def all_oracles() -> dict[str, str]:
    return dict(_ORACLES)
