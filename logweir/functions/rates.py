"""Exact decimal rates, rounded half up like SQL NUMERIC."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, scale: int, dtype: str) -> Column:
    """``numerator / denominator`` rounded half up to ``scale`` digits, 0 if denominator <= 0.

    Both arguments are non-negative whole numbers. Integer division on decimals avoids the
    double rounding of "divide, then round".
    """
    n = numerator.cast("decimal(27,0)")
    d = denominator.cast("decimal(20,0)")
    twice = F.lit(2).cast("decimal(1,0)")
    factor = F.lit(2 * 10**scale).cast("decimal(10,0)")
    units = F.call_function("div", n * factor + d, d * twice)
    unit = F.lit(Decimal(1).scaleb(-scale)).cast(f"decimal(18,{scale})")
    return (
        F.when(denominator > 0, (units.cast("decimal(18,0)") * unit).cast(dtype))
        .otherwise(F.lit(0).cast(dtype))
    )


def messages_per_sec(count: Column, start: Column, end: Column) -> Column:
    """Messages per second of a window as ``decimal(10,2)``; 0 for an empty interval."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    per_micro = count.cast("decimal(20,0)") * F.lit(1_000_000).cast("decimal(7,0)")
    return ratio(per_micro, micros, 2, "decimal(10,2)")


def percentage(part: Column, whole: Column, dtype: str = "decimal(5,2)") -> Column:
    """``part / whole * 100`` with two digits; 0 if whole is 0."""
    return ratio(part.cast("decimal(20,0)") * F.lit(100).cast("decimal(3,0)"), whole, 2, dtype)


def mean(total: Column, count: Column, scale: int, dtype: str) -> Column:
    """Arithmetic mean of whole numbers, rounded half up."""
    return ratio(total, count, scale, dtype)
