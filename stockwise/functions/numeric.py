"""Rounding, clipping, ratios, pack sizes and error bands."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Right-closed error bands and their labels.
BAND_EDGES = (0.2, 0.4, 0.6, 0.8, 1.0)
BAND_LABELS = ("pe20", "pe40", "pe60", "pe80", "pe100", "pe_more")


def half_even(value: Column, digits: int = 0) -> Column:
    """Half-even rounding on the binary value; adding 0.0 turns a negative zero positive."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def nan_to_null(value: Column) -> Column:
    return F.when(F.isnan(value), None).otherwise(value)


def at_least(value: Column, low: float = 0.0) -> Column:
    """Lower clip that keeps NULL (``greatest`` would drop it)."""
    return F.when(value < F.lit(low), F.lit(low)).otherwise(value)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.when(value < F.lit(low), F.lit(low)).when(value > F.lit(high), F.lit(high)).otherwise(value)


def safe_ratio(numerator: Column, denominator: Column, default: float = 0.0) -> Column:
    """Division whose zero or missing denominators give ``default`` instead of inf or NaN."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(default))


def ceil_units(quantity: Column, unit: Column) -> Column:
    """Number of whole units that cover ``quantity``."""
    return F.ceil(F.try_divide(quantity, unit)).cast("double")


def ceil_to_multiple(quantity: Column, unit: Column) -> Column:
    return ceil_units(quantity, unit) * unit


def box_round(quantity: Column, box: Column) -> Column:
    """Nothing stays nothing, less than a box becomes one box, the rest rounds to whole boxes."""
    lifted = F.when((quantity > 0) & (quantity < box), box).otherwise(quantity)
    return half_even(F.try_divide(lifted, box)) * box


def band_label(error: Column) -> Column:
    chain = None
    for edge, label in zip(BAND_EDGES, BAND_LABELS):
        chain = F.when(error <= edge, label) if chain is None else chain.when(error <= edge, label)
    return F.when(error.isNotNull(), chain.otherwise(BAND_LABELS[-1]))


def band_flags(error: Column) -> dict[str, Column]:
    """One 0/1 column per band."""
    label = band_label(error)
    return {name: F.coalesce((label == name).cast("long"), F.lit(0)) for name in BAND_LABELS}
