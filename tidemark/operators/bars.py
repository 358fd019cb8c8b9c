"""Price bars."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.amounts import from_units, to_units, total
from tidemark.functions.prices import as_token1, is_up


def ohlcv(trades: DataFrame, every: str = "10 minutes", normalize: bool = True,
          keys: Sequence[str] = ("market_id",)) -> DataFrame:
    """Open, high, low, close and cash volume per market and interval, labelled by its start.

    Ties within a second are ordered by id. Trades without a price add volume only; a bar of
    nothing else is dropped.
    """
    price = F.col("price")
    if normalize:
        price = as_token1(price, F.col("nonusdc_side"))
    priced = trades.select(
        *keys, "timestamp", price.alias("price"), to_units(F.col("usd_amount")).alias("units"),
        F.when(price.isNotNull(), F.struct("timestamp", "id")).alias("at"))
    bars = priced.groupBy(*keys, F.window("timestamp", every).alias("w")).agg(
        F.min_by("price", "at").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", "at").alias("close"),
        from_units(total(F.col("units"))).alias("volume"))
    return bars.filter(F.col("open").isNotNull()).select(
        *keys, F.col("w.start").alias("timestamp"), "open", "high", "low", "close", "volume")


def bars_since(bars: DataFrame, start: Column, exclude: Iterable[Column] = ()) -> DataFrame:
    """Bars from a start time on, without the listed broken ones."""
    kept = bars.filter(F.col("timestamp") >= start)
    for broken in exclude:
        kept = kept.filter(F.col("timestamp") != broken)
    return kept


def bar_direction(bars: DataFrame) -> DataFrame:
    return bars.withColumn("is_up", is_up(F.col("open"), F.col("close")))


def feed(bars: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Bars under the column names a consumer binds to; ``mapping`` is {target: source}."""
    return bars.select(*[F.col(source).alias(target) for target, source in mapping.items()])
