"""Where ingestion goes on: a stored cursor, checked when it is read, with the data to fall back on.

Fills arrive in pages by (time, id). A full page may end in the middle of a second, so the cursor
stays in that second and asks for larger ids until a page is not full.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.commits import commit, committed


class Cursor(NamedTuple):
    """The last complete second; in an open second, that second and the last id seen in it."""

    last_timestamp: int = 0
    last_id: str | None = None
    sticky_timestamp: int | None = None

    def wanted(self, ts: str = "timestamp", ident: str = "id") -> Column:
        """Which fills are still to come."""
        if self.sticky_timestamp is None:
            return F.col(ts) > self.last_timestamp
        return (F.col(ts) > self.sticky_timestamp) | (
            (F.col(ts) == self.sticky_timestamp) & (F.col(ident) > self.last_id))

    def after(self, page: DataFrame, page_size: int) -> "Cursor":
        """The cursor once ``page`` (timestamp, id), at most ``page_size`` rows, is stored."""
        last = F.max(F.struct("timestamp", "id"))
        n, end = page.agg(F.count(F.lit(1)), last).head()
        if n >= page_size:
            return Cursor(self.last_timestamp, end["id"], end["timestamp"])
        if self.sticky_timestamp is not None:
            return Cursor(self.sticky_timestamp)
        return Cursor(end["timestamp"]) if n else self


def _valid(state: dict) -> Cursor | None:
    """A cursor from a stored state, or None. An open second without an id is closed."""
    ts, ident, sticky = (state.get(name) for name in Cursor._fields)
    if not isinstance(ts, int) or not isinstance(ident, str | None) or not isinstance(sticky, int | None):
        return None
    if ts < 0 or (ts == 0 and sticky is None):
        return None
    if sticky is None or ident is None:
        return Cursor(ts) if ts > 0 else None
    return Cursor(ts, ident, sticky)


def save_cursor(spark: SparkSession, path: str, cursor: Cursor) -> None:
    commit(spark, path, cursor._asdict())


def load_cursor(spark: SparkSession, path: str, stored: DataFrame | None = None) -> Cursor:
    """The newest whole and valid cursor of the log at ``path``.

    Without one, the second before the last of ``stored`` (the fills that are held), which may
    fetch some of them again but misses none; without fills, the beginning of time.
    """
    for state in committed(spark, path):
        cursor = _valid(state)
        if cursor:
            return cursor
    last = stored.agg(F.max("timestamp")).head()[0] if stored is not None else None
    return Cursor() if last is None else Cursor(last - 1)
