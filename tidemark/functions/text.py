"""Text and JSON helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters that a chart column name may not hold.
ILLEGAL_NAME_CHARS = "(),.*:/^"
_ILLEGAL = "[" + re.escape(ILLEGAL_NAME_CHARS) + "_]+"


def safe_name(name: Column) -> Column:
    """Illegal characters become ``_``; runs of ``_`` shrink to one; none at the ends."""
    return F.trim(F.regexp_replace(name, _ILLEGAL, "_"), F.lit("_"))


def safe_label(name: str) -> str:
    """The same rule for a name known on the driver."""
    return re.sub(_ILLEGAL, "_", name).strip("_")


def json_list(text: Column) -> Column:
    """A JSON array of strings; absent text is the empty list, malformed text is null."""
    return F.from_json(F.coalesce(text, F.lit("[]")), "array<string>")


def item(values: Column, index: int, default: str) -> Column:
    return F.coalesce(F.get(values, F.lit(index)), F.lit(default))


def first_filled(*candidates: Column) -> Column:
    """The first text that is neither null nor empty, else the empty text."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in candidates], F.lit(""))


def epoch_text(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss 'UTC'")


def day_of(ts: Column, unit: str = "day") -> Column:
    """A partition value: the day of a time, or the first day of its month, quarter or year."""
    return F.to_date(F.date_trunc(unit, ts))
