"""First and last rows of stored tables, from their newest date folders alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import epoch_text
from tidemark.operators.fills import high_water_mark, safe_high_water_mark
from tidemark.sources.commits import Folder
from tidemark.sources.readers import read_fills


def stored_dates(spark: SparkSession, path: str) -> list[str]:
    """Dates of a table from ``write_fills`` or ``write_trades``, by its folder names; no file is
    opened."""
    return [n.removeprefix("date=") for n in Folder(spark, path).names() if n.startswith("date=")]


def stored_high_water_mark(spark: SparkSession, path: str) -> DataFrame:
    """``high_water_mark`` of stored fills, from the newest date folder that holds any."""
    for date in reversed(stored_dates(spark, path)):
        mark = high_water_mark(read_fills(spark, path, dates=(date, date)))
        if not mark.filter(F.col("last_timestamp").isNotNull()).isEmpty():
            return mark
    return high_water_mark(read_fills(spark, path))


def stored_safe_mark(spark: SparkSession, path: str) -> DataFrame:
    """``safe_high_water_mark`` of stored fills, from the fewest newest date folders that hold two
    different seconds."""
    dates = stored_dates(spark, path)
    for first in reversed(dates):
        newest = read_fills(spark, path, dates=(first, dates[-1]))
        span = newest.agg(F.min("timestamp"), F.max("timestamp")).head()
        if span[0] is not None and span[0] < span[1]:
            return safe_high_water_mark(newest)
    return safe_high_water_mark(read_fills(spark, path))


def with_time(mark: DataFrame) -> DataFrame:
    """A safe mark with its second as text, for logs."""
    return mark.withColumn("safe_time", epoch_text(F.col("safe_timestamp")))
