"""Many series on one clock.

A series table has (run_id, series, timestamp, value) with one row per series and time. A value
may be NaN, which is a value; a missing one is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.prices import clip_area
from tidemark.functions.text import safe_label
from tidemark.operators.chunks import running_index, running_last


def master_clock(series: DataFrame) -> DataFrame:
    """Every time at which any series of a run has a row."""
    return series.select("run_id", "timestamp").distinct()


def axis_index(clock: DataFrame) -> DataFrame:
    """A gap-free position per run for each clock time."""
    return running_index(clock, ["run_id"]).drop("total")


def _grid(clock: DataFrame, series: DataFrame) -> DataFrame:
    """Clock times of a run for each of its series, as the aligned result must hold them."""
    names = series.select("run_id", "series").distinct()
    return clock.select("run_id", "timestamp").join(names, "run_id")


def align_exact(clock: DataFrame, series: DataFrame) -> DataFrame:
    """The value at exactly each clock time, null where a series has no row."""
    key = ["run_id", "series", "timestamp"]
    return _grid(clock, series).join(series.select(*key, "value"), key, "left")


def align_ffill(clock: DataFrame | None, series: DataFrame) -> DataFrame:
    """The newest value at or before each clock time, null before a series starts. Without a
    ``clock``, times are all those of any series of the run (``master_clock``).

    The value travels inside a struct, so that NaN is carried on while a missing row is not.
    All values of one time are gathered first and spread over the run's series after meeting the
    clock, so that rows move by time once and by series and chunk once. What a run's series are
    follows from the gathered values too, which are shuffled once for both.
    """
    at = ["run_id", "timestamp"]
    own = F.collect_list(F.when(F.col("series").isNotNull(), F.struct("series", F.struct("value"))))
    cells = series.groupBy(*at).agg(F.map_from_entries(own).alias("cells"))
    names = cells.select("run_id", F.explode(F.map_keys("cells")).alias("name")).groupBy("run_id").agg(
        F.collect_set("name").alias("names"))
    if clock is None:
        slots = cells.withColumn("is_clock", F.lit(1))
    else:
        slots = clock.select(*at, F.lit(1).alias("is_clock")).join(cells, at, "full")
    rows = slots.join(names, "run_id").select(
        *at, "is_clock", "cells", F.explode("names").alias("series")).select(
        *at, "is_clock", "series", F.col("cells")[F.col("series")].alias("v"))
    filled = running_last(rows, ["run_id", "series"], "v", ["is_clock"])
    return filled.filter("is_clock = 1").select(
        "run_id", "series", "timestamp", F.col("v.value").alias("value"))


def wide_series(aligned: DataFrame, names: Sequence[str]) -> DataFrame:
    """One column per listed series; names lose the characters a column name may not hold."""
    return aligned.groupBy("run_id", "timestamp").agg(*[
        F.max(F.when(F.col("series") == name, F.col("value"))).alias(safe_label(name))
        for name in names])


def area_clip(df: DataFrame, x: str, ref: float | str, op: str) -> DataFrame:
    """Adds ``<x>_fill_<op>``: x where it is beyond the reference value or column."""
    other = F.col(ref) if isinstance(ref, str) else F.lit(float(ref))
    return df.withColumn(f"{x}_fill_{op}", clip_area(F.col(x), other, op))


def lookback(series: DataFrame, n: int = 23, keys: Sequence[str] = ("run_id", "series")
             ) -> DataFrame:
    """The newest n rows of each series; Spark keeps n per task before it shuffles."""
    newest = Window.partitionBy(*keys).orderBy(F.col("timestamp").desc())
    return series.withColumn("_rn", F.row_number().over(newest)).filter(
        F.col("_rn") <= n).drop("_rn")


def slice_series(series: DataFrame, start: int | Column | None = None,
                 end: int | Column | None = None,
                 keys: Sequence[str] = ("run_id", "series")) -> DataFrame:
    """Rows of each series between two limits.

    A time limit (Column) is inclusive. A whole number is a position: the start is inclusive,
    the end exclusive, and a negative end counts from the back, -1 being the whole series.
    """
    by_position = isinstance(start, int) or isinstance(end, int)
    rows = running_index(series, list(keys)) if by_position else series
    at, index = F.col("timestamp"), F.col("index")
    if isinstance(start, int):
        rows = rows.filter(index >= start)
    elif start is not None:
        rows = rows.filter(at >= start)
    if isinstance(end, int):
        rows = rows.filter(index < (F.lit(end) if end >= 0 else F.col("total") + 1 + end))
    elif end is not None:
        rows = rows.filter(at <= end)
    return rows.select(*series.columns)
