"""Exact money arithmetic: amounts are summed as whole micro-units, never as doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: on-chain amounts carry six decimals.
MICRO = 1_000_000


def to_units(amount: Column) -> Column:
    """A decimal amount as whole micro-units (long)."""
    return F.rint(amount * F.lit(float(MICRO))).cast("long")


def from_units(units: Column) -> Column:
    """Micro-units as a double amount; one division, so the nearest double."""
    return units / F.lit(float(MICRO))


def settle(value: Column, digits: int = 6) -> Column:
    """Half-even rounding that stays inside generated code; never yields a negative zero."""
    scale = F.lit(float(10 ** digits))
    return F.rint(value * scale) / scale + F.lit(0.0)


def total(units: Column) -> Column:
    """Sum of whole units where no non-null value counts as 0."""
    return F.coalesce(F.sum(units), F.lit(0))
