"""Ordered running results over series of any length.

A window over one long series would put it into one task. Here each series is cut into chunks
of time; a chunk is ordered on its own, and what earlier chunks hand on is computed from one
summary row per chunk.

:func:`scan` adds any number of running results in one pass. Each is a :class:`Running`: how a
chunk is summed up, how summaries before (or after) a chunk combine, what a row sees inside its own
chunk, and how both meet. Series that the calendar bounds, such as bars of minutes, may do without
chunks: then one sorted window per series gives the same results with one shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemark.session import stage

CHUNK_SECONDS = 86_400


def chunk_of(ts: str, seconds: int | None = CHUNK_SECONDS) -> Column | None:
    """Number of the stretch of time that a row is in; times may be plain seconds too."""
    return None if seconds is None else F.floor(F.col(ts).cast("long") / F.lit(seconds))


@dataclass(frozen=True)
class Running:
    """``summary`` takes the order of rows as one column, ``carry`` a summary and a window over
    chunks, ``local`` a window over rows; ``meet`` takes what is carried and what is local."""

    summary: Callable[[Column], Column]
    carry: Callable[[Column, WindowSpec], Column]
    local: Callable[[WindowSpec], Column]
    meet: Callable[[Column, Column], Column]


def _upto(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def _before(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _last_of(name: Column, w: WindowSpec) -> Column:
    return F.last(name, ignorenulls=True).over(_before(w))


def count() -> Running:
    """Number of rows up to this one, itself included."""
    return Running(lambda order: F.count(F.lit(1)),
                   lambda n, w: F.coalesce(F.sum(n).over(_before(w)), F.lit(0)),
                   lambda w: F.row_number().over(w), lambda a, b: a + b)


def total(value: Column) -> Running:
    """Sum of a value up to this row; nulls add nothing."""
    return Running(lambda order: F.sum(value), lambda part, w: F.sum(part).over(_before(w)),
                   lambda w: F.sum(value).over(_upto(w)),
                   lambda a, b: F.coalesce(a + b, a, b))


def highest(value: Column) -> Running:
    """Largest value up to this row."""
    return Running(lambda order: F.max(value), lambda part, w: F.max(part).over(_before(w)),
                   lambda w: F.max(value).over(_upto(w)), F.greatest)


def newest(value: Column, before: bool = False) -> Running:
    """Last non-null value up to this row, or among those before it."""
    return Running(lambda order: F.max_by(value, F.when(value.isNotNull(), order)), _last_of,
                   lambda w: F.last(value, ignorenulls=True).over(_before(w) if before else _upto(w)),
                   lambda a, b: F.coalesce(b, a))


def following(value: Column) -> Running:
    """The (non-null) value of the next row; null at the last."""
    return Running(lambda order: F.min_by(value, order), lambda part, w: F.lead(part).over(w),
                   lambda w: F.lead(value).over(w), lambda a, b: F.coalesce(b, a))


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Whether columns are equal in pairs, null equal to null."""
    return reduce(Column.__and__, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def scan(df: DataFrame, keys: Sequence[str], wanted: dict[str, Running],
         order: Sequence[str] = ("timestamp",), chunk: Column | None = None) -> DataFrame:
    """``df`` with the ``wanted`` running results of every series (``keys``), rows by ``order``.

    With a ``chunk``, which must follow the order of rows, no series is sorted as a whole; the rows
    are then staged (see ``session``), as chunks and their summaries both read them.
    """
    if chunk is None:
        whole = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({c: r.local(whole) for c, r in wanted.items()})
    cut = stage(df.withColumn("_chunk", chunk), "chunks")
    own = [*keys, "_chunk"]
    parts = cut.groupBy(*own).agg(*[r.summary(F.struct(*order)).alias(c) for c, r in wanted.items()])
    chunks = Window.partitionBy(*keys).orderBy("_chunk")
    of = [f"_of_{i}" for i in range(len(own))]
    carried = parts.select(*[F.col(c).alias(o) for c, o in zip(own, of)],
                           *[r.carry(F.col(c), chunks).alias(f"_carried_{c}") for c, r in wanted.items()])
    rows = Window.partitionBy(*own).orderBy(*order)
    local = cut.withColumns({f"_local_{c}": r.local(rows) for c, r in wanted.items()})
    return local.join(carried, same(own, of)).select(*df.columns, *[
        r.meet(F.col(f"_carried_{c}"), F.col(f"_local_{c}")).alias(c) for c, r in wanted.items()])


def running_index(df: DataFrame, keys: Sequence[str], ts: str = "timestamp",
                  ties: Sequence[str] = (), seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Adds ``index`` (from 0, by time) and ``total`` (rows) per key."""
    cut = df.withColumn("_chunk", chunk_of(ts, seconds))
    sizes = cut.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_size"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys, "_chunk",
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_size").over(whole).alias("total"))
    local = F.row_number().over(Window.partitionBy(*keys, "_chunk").orderBy(ts, *ties)) - 1
    return (
        cut.withColumn("_local", local)
        .join(offsets, [*keys, "_chunk"])
        .withColumn("index", F.col("_offset") + F.col("_local"))
        .drop("_chunk", "_local", "_offset")
    )


def running_last(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str],
                 ts: str = "timestamp", seconds: int = CHUNK_SECONDS) -> DataFrame:
    """Replaces ``value`` by the newest non-null value up to each row.

    ``order`` lists what follows the time in the order of rows.
    """
    cut = df.withColumn("_chunk", chunk_of(ts, seconds))
    newest = F.max(F.when(F.col(value).isNotNull(), F.struct(ts, *order, value)))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    carried = (
        cut.groupBy(*keys, "_chunk").agg(newest.alias("_newest"))
        .select(*keys, "_chunk",
                F.last("_newest", ignorenulls=True).over(earlier)[value].alias("_carried"))
    )
    upto = Window.partitionBy(*keys, "_chunk").orderBy(ts, *order).rowsBetween(
        Window.unboundedPreceding, 0)
    return (
        cut.withColumn("_local", F.last(value, ignorenulls=True).over(upto))
        .join(carried, [*keys, "_chunk"])
        .withColumn(value, F.coalesce("_local", "_carried"))
        .drop("_chunk", "_local", "_carried")
    )
