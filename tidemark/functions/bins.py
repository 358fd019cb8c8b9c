"""Labels for how many makers one taker order met."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds (inclusive) and labels of the bins; the last bin is open.
DEPTH_BOUNDS = (1, 2, 3, 5, 10, 25, 50, 100)
DEPTH_LABELS = ("1", "2", "3", "4-5", "6-10", "11-25", "26-50", "51-100", "100+")


def depth_order(makers: Column) -> Column:
    """Position of the right-closed bin, from 0; null outside (0, inf)."""
    inside = reduce(
        lambda ladder, step: ladder.when(makers <= step[1], F.lit(step[0])),
        list(enumerate(DEPTH_BOUNDS)),
        F.when((makers <= 0) | makers.isNull(), F.lit(None).cast("int")),
    )
    return inside.otherwise(F.lit(len(DEPTH_BOUNDS)))
