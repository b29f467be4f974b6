"""Registered queries: operators applied to the logical input views."""

from importlib import import_module

from stockwise.plans.registry import all_oracles, all_queries

for _area in ("windowing", "scans", "columns", "joining", "aggregating", "forecasting", "accuracy_marts", "planning", "products", "monitoring", "learned"):
    import_module(f"stockwise.plans.{_area}")

__all__ = ["all_oracles", "all_queries"]
