"""Sizes, costs and their rounding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

COST_PER_GB_MONTH = 0.02

# 2**27 + 1 splits a double into two halves whose products with small integers are exact.
_SPLITTER = 134217729.0


def bytes_to_gb(total_bytes: Column) -> Column:
    return total_bytes / 1024 / 1024 / 1024


def round2(x: Column) -> Column:
    """Two decimals, half to even on the *binary* value: 2.675 gives 2.67, 0.125 gives 0.12.

    Spark's ``round`` and ``bround`` look at the shortest decimal text instead and differ at such
    values. ``scaled`` is x*100 rounded to a double and ``error`` is exactly what that rounding lost,
    so a value just beside a tie can be told from a tie.
    """
    scaled = x * 100.0
    shifted = x * _SPLITTER
    high = shifted - (shifted - x)
    error = (high * 100.0 - scaled) + (x - high) * 100.0
    cents = F.floor(scaled)
    beyond_half = (scaled - cents.cast("double")) - 0.5
    up = (beyond_half > 0) | (
        (beyond_half == 0) & ((error > 0) | ((error == 0) & (F.pmod(cents, F.lit(2)) == 1)))
    )
    return F.when(up, cents + 1).otherwise(cents).cast("double") / 100.0


def monthly_cost(size_gb: Column, rate: float = COST_PER_GB_MONTH) -> Column:
    """Cost of the unrounded size, then rounded."""
    return round2(size_gb * rate)


def exact_total(x: Column) -> Column:
    """Sum of decimal-looking doubles, independent of the order in which partitions arrive."""
    return F.coalesce(F.sum(x.cast("decimal(28,6)")).cast("double"), F.lit(0.0))


def thousands(x: Column, decimals: int) -> Column:
    return F.format_number(x, decimals)


def float_text(x: Column) -> Column:
    """A double as it stands, up to ten decimals, without padding or scientific notation: 10.0, 12.5, 1.234."""
    return F.regexp_replace(x.cast("decimal(38,10)").cast("string"), r"(\.\d+?)0+$", "$1")
