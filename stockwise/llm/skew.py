"""Joins on keys of which a few may hold any share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Keys with at least this share of all rows are few: at most as many as the number says.
HOT_SHARE = 1000


def looked_up(rows: DataFrame, table: DataFrame, on: Sequence[str], hot: DataFrame) -> DataFrame:
    """Inner join of ``rows`` with ``table``, which has one row per key.

    hot: the rows of ``table`` whose keys are frequent in ``rows``, a list whose size the caller bounds.  They meet ``rows``
    where these are; only the other rows move.
    """
    new = [c for c in table.columns if c not in on]
    listed = hot.select(*on, F.struct(*new).alias("__found"))
    marked = rows.join(F.broadcast(listed), list(on), "left")
    at_once = marked.filter("__found IS NOT NULL").select(*rows.columns, "__found.*")
    moved = marked.filter("__found IS NULL").drop("__found").join(table, list(on))
    return at_once.unionByName(moved.select(*rows.columns, *new))
