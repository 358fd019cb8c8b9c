"""Order fills to labelled trades."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fills as ff
from tidemark.functions.amounts import from_units
from tidemark.operators.markets import markets_long


def with_nonusdc_asset(fills: DataFrame) -> DataFrame:
    return fills.withColumn("nonusdc_asset_id", ff.nonusdc_asset())


def one_market_per_token(markets: DataFrame) -> DataFrame:
    owner = F.min(F.struct("market_id", "side")).alias("owner")
    return markets_long(markets).groupBy("asset_id").agg(owner).select("asset_id", "owner.*")


def label_trades(fills: DataFrame, markets: DataFrame | None, tokens: DataFrame | None = None
                 ) -> DataFrame:
    """One labelled trade per fill. ``tokens`` gives the token map of ``markets`` where it is made
    already, as :func:`tidemark.sources.tokens.stage_tokens` does for many batches.

    A token that several markets list belongs to the one with the smallest id, so that a fill
    never becomes two trades. One left join on the outcome token. Spark broadcasts the token map while its estimate is
    below ``spark.sql.autoBroadcastJoinThreshold``; beyond that it shuffles, and adaptive
    execution splits the partitions of heavily traded tokens.

    A token without a market has no side. The label then follows from the fill alone: 'USDC'
    when the taker paid cash, null otherwise; in the second case token_amount holds the
    maker's cash amount. ``is_matched`` marks such rows for a later repair.
    """
    if tokens is None:
        tokens = one_market_per_token(markets)
    # whether the taker pays is all that is left of two long asset ids: less to shuffle
    rows = with_nonusdc_asset(fills).withColumn("_taker_pays", ff.taker_pays_cash())
    taker_pays = F.col("_taker_pays")
    maker_amount, taker_amount = F.col("makerAmountFilled"), F.col("takerAmountFilled")
    matched = F.col("market_id").isNotNull()
    cash = F.when(taker_pays, taker_amount).otherwise(maker_amount)
    tokens_moved = F.when(~taker_pays & matched, taker_amount).otherwise(maker_amount)
    other = F.when(taker_pays, maker_amount).otherwise(taker_amount)
    return (
        rows.join(tokens, F.col("nonusdc_asset_id") == tokens["asset_id"], "left")
        .select(
            "id",
            F.timestamp_seconds("timestamp").alias("timestamp"),
            "market_id",
            "maker",
            "taker",
            F.coalesce("side", F.when(taker_pays, F.lit(ff.USDC))).alias("nonusdc_side"),
            ff.direction(~taker_pays).alias("maker_direction"),
            ff.direction(taker_pays).alias("taker_direction"),
            F.try_divide(cash.cast("double"), other.cast("double")).alias("price"),
            from_units(cash).alias("usd_amount"),
            from_units(tokens_moved).alias("token_amount"),
            "transactionHash",
            matched.alias("is_matched"),
        )
    )


def label_by_token(fills: DataFrame, markets: DataFrame) -> DataFrame:
    """:func:`label_trades` that always shuffles fills to their tokens, so that each task has whole
    tokens, or a part of a heavily traded one: the form in which trades can be written at once."""
    return label_trades(fills, markets, one_market_per_token(markets).hint("merge"))


def repair_unmatched(trades: DataFrame, fills: DataFrame, markets: DataFrame) -> DataFrame:
    """Label unmatched trades again, now that more markets are known; others pass unchanged."""
    stale = trades.filter(~F.col("is_matched"))
    again = fills.join(stale.select("id"), "id", "left_semi")
    return trades.filter("is_matched").unionByName(label_trades(again, markets))


def incremental_trades(fills: DataFrame, trades: DataFrame, markets: DataFrame,
                       since: int | None = None) -> DataFrame:
    """Trades for the fills that ``trades`` does not hold yet, found by id.

    ``since`` (epoch seconds) prunes both inputs when no older fill can be new.
    """
    if since is not None:
        fills = fills.filter(F.col("timestamp") >= since)
        trades = trades.filter(F.col("timestamp") >= F.timestamp_seconds(F.lit(since)))
    return label_trades(fills.join(trades.select("id"), "id", "left_anti"), markets)


def quality_report(fills: DataFrame, markets: DataFrame) -> DataFrame:
    """Counts of what deserves a second look, as (check, rows).

    A token that several markets list labels its fills with the smallest of them.
    """
    trades = label_trades(fills, markets)
    maker_cash = F.col("makerAssetId") == ff.USDC_ASSET
    taker_cash = F.col("takerAssetId") == ff.USDC_ASSET
    no_market, side = ~F.col("is_matched"), F.col("nonusdc_side")
    checks = [
        fills.agg(
            F.count(F.lit(1)).alias("fills"),
            F.count_if(~maker_cash & ~taker_cash).alias("token_swaps"),
            F.count_if(maker_cash & taker_cash).alias("cash_swaps"),
            F.count_if((F.col("makerAmountFilled") == 0) | (F.col("takerAmountFilled") == 0))
            .alias("zero_amounts")),
        trades.agg(
            F.count_if(no_market & (side == ff.USDC)).alias("unmatched_maker_tokens"),
            F.count_if(no_market & side.isNull()).alias("unmatched_taker_tokens")),
        markets_long(markets).groupBy("asset_id").agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count_if(F.col("n") > 1).alias("shared_tokens")),
    ]
    rows = [one.unpivot([], one.columns, "check", "rows") for one in checks]
    return reduce(DataFrame.unionByName, rows)
