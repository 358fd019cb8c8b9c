"""Column expressions over prices."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def snap_to_outcome(price: Column, hi: float = 0.98, lo: float = 0.02) -> Column:
    """Prices strictly beyond the limits count as resolved: 1 or 0."""
    return F.when(price > hi, F.lit(1.0)).when(price < lo, F.lit(0.0)).otherwise(price)


def as_token1(price: Column, side: Column) -> Column:
    """Every price seen from the first outcome: a second-outcome price p becomes 1 - p."""
    return F.when(side == "token2", 1 - price).otherwise(price)


def is_up(open_: Column, close: Column) -> Column:
    """True for a bar that did not fall; null where the bar has no open."""
    return F.when(~F.isnan(open_), close >= open_)


def clip_area(x: Column, ref: Column, op: str) -> Column:
    """``x`` where it lies beyond ``ref`` on the given side, ``ref`` elsewhere.

    A NaN on either side compares false, so the result there is ``ref``; Spark alone would
    order NaN above every number.
    """
    beyond = {"gt": x > ref, "lt": x < ref}[op]
    return F.when(beyond & ~F.isnan(x) & ~F.isnan(ref), x).otherwise(ref)


def not_nan(x: Column) -> Column:
    return F.nullif(x, F.lit(float("nan")))
