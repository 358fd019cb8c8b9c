"""How many makers one taker transaction meets, and where the volume lies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.amounts import from_units, settle, to_units
from tidemark.functions.bins import DEPTH_LABELS, depth_order


def match_depth(trades: DataFrame, rsd: float | None = None) -> DataFrame:
    """Distinct makers and cash volume per transaction; a null maker counts as one value.

    Grouped by (transaction, maker) first, so no transaction is held in one task. With ``rsd``
    (relative deviation) a sketch counts the makers in one step instead, null ones not included.
    """
    if rsd is not None:
        return trades.groupBy("transactionHash").agg(
            F.approx_count_distinct("maker", rsd).alias("num_makers_matched"),
            from_units(F.sum(to_units(F.col("usd_amount")))).alias("total_volume"))
    per_maker = trades.groupBy("transactionHash", "maker").agg(
        F.sum(to_units(F.col("usd_amount"))).alias("units"))
    return per_maker.groupBy("transactionHash").agg(
        F.count(F.lit(1)).alias("num_makers_matched"),
        from_units(F.sum("units")).alias("total_volume"))


def match_depth_summary(depth: DataFrame) -> DataFrame:
    """Mean and exact median of makers per transaction.

    Reduced to one row per distinct count first: n transactions with all different counts
    would need n*n/2 trades, so that table is small for any input.
    """
    histogram = depth.groupBy("num_makers_matched").agg(F.count(F.lit(1)).alias("n"))
    makers = F.col("num_makers_matched")
    return histogram.agg(
        F.sum("n").alias("transactions"),
        (F.sum(makers * F.col("n")) / F.sum("n")).alias("avg_makers"),
        F.percentile(makers, 0.5, F.col("n")).alias("median_makers"))


def volume_by_depth(depth: DataFrame) -> DataFrame:
    """Volume and share of the total per bin of makers matched; empty bins are left out.

    One global aggregate holds every bin, so the total needs neither a join nor a window.
    """
    bin_no = depth_order(F.col("num_makers_matched"))
    units = to_units(F.col("total_volume")).cast("decimal(38,0)")
    sums = depth.agg(
        F.sum(F.when(bin_no.isNotNull(), units)).alias("all"),
        *[F.sum(F.when(bin_no == i, units)).alias(f"b{i}") for i in range(len(DEPTH_LABELS))])
    rows = F.array(*[
        F.struct(F.lit(i).alias("bin_order"), F.lit(label).alias("bin"),
                 F.col(f"b{i}").cast("double").alias("units"))
        for i, label in enumerate(DEPTH_LABELS)])
    return (
        sums.select(F.col("all").cast("double").alias("all"), F.inline(rows))
        .filter(F.col("units").isNotNull())
        .select("bin_order", "bin", from_units(F.col("units")).alias("total_volume"),
                settle(F.col("units") / F.col("all") * 100, 4).alias("volume_pct"))
    )
