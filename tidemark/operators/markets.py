"""The market dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def combine_markets(main: DataFrame, missing: DataFrame | None = None) -> DataFrame:
    """One row per market id; the main source wins over the late one."""
    ranked = main.withColumn("source_rank", F.lit(0))
    if missing is not None:
        ranked = ranked.unionByName(missing.withColumn("source_rank", F.lit(1)))
    first = Window.partitionBy("id").orderBy("source_rank", "createdAt", "market_slug")
    return (
        ranked.withColumn("_rn", F.row_number().over(first))
        .filter("_rn = 1")
        .drop("_rn", "source_rank")
    )


def by_creation(markets: DataFrame) -> DataFrame:
    return markets.orderBy("createdAt", "id")


def markets_long(markets: DataFrame) -> DataFrame:
    """(market_id, side, asset_id): one row per outcome token."""
    return (
        markets.select(F.col("id").alias("market_id"), "token1", "token2")
        .unpivot("market_id", ["token1", "token2"], "side", "asset_id")
        .filter("asset_id <> ''")
    )


def find_market(markets: DataFrame, pattern: str, descending: bool = False) -> DataFrame:
    """The lowest-volume market (highest with ``descending``) whose question matches a regex."""
    volume = F.col("volume")
    order = volume.desc_nulls_last() if descending else volume.asc_nulls_first()
    return markets.filter(F.col("question").rlike(pattern)).orderBy(order, "id").limit(1)


def new_markets(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates whose id is not known yet."""
    return candidates.join(known.select("id"), "id", "left_anti")


def market_of_question(markets: DataFrame) -> DataFrame:
    return markets.select(F.col("id").alias("market_id"), "question")


def market_times(markets: DataFrame) -> DataFrame:
    """Creation and close as timestamps in UTC, whatever zone the text names; null if unreadable."""
    return markets.withColumns({
        "created_at": F.try_to_timestamp("createdAt"),
        "closed_at": F.try_to_timestamp("closedTime")})
