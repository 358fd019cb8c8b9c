"""Raw order fills: de-duplication, traded assets, ingest checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.fills import USDC_ASSET
from tidemark.functions.text import epoch_text

# Which of several rows with one id survives: the smallest in this column order.
_CHOICE = ("timestamp", "maker", "taker", "makerAssetId", "takerAssetId",
           "makerAmountFilled", "takerAmountFilled", "transactionHash")


def first_of(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, by ``order``. Spark keeps one per key and task before it shuffles."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).filter("_place = 1").drop("_place")


def dedup_fills(fills: DataFrame) -> DataFrame:
    """One row per id over the whole input; null is an id.

    The first row of each id stays per task before the shuffle, so an id that holds a large share
    of the rows costs no more than any other. Columns that the caller dropped choose nothing.
    """
    return first_of(fills, ["id"], [c for c in _CHOICE if c in fills.columns])


def order_fills(fills: DataFrame) -> DataFrame:
    return fills.orderBy("timestamp", "id")


def _asset_ids(fills: DataFrame) -> DataFrame:
    ids = F.explode(F.array("makerAssetId", "takerAssetId")).alias("asset_id")
    return fills.select(ids).filter(F.col("asset_id") != USDC_ASSET).distinct()


def traded_assets(fills: DataFrame) -> DataFrame:
    """Every outcome token that any fill mentions, on either side."""
    return _asset_ids(fills)


def missing_tokens(fills: DataFrame, tokens: DataFrame) -> DataFrame:
    """Traded tokens that no market lists, sorted. ``tokens`` has ``asset_id``."""
    return (
        _asset_ids(fills)
        .join(tokens.select("asset_id"), "asset_id", "left_anti")
        .orderBy("asset_id")
    )


def time_segments(bounds: DataFrame, n: int) -> DataFrame:
    """Split each (start_ts, end_ts] row into n half-open ranges; the last takes the rest."""
    step = F.expr(f"(end_ts - start_ts) div {n}")
    return (
        bounds.select("start_ts", "end_ts", step.alias("step"),
                      F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("segment"))
        .select(
            "segment",
            (F.col("start_ts") + F.col("segment") * F.col("step")).alias("start_ts"),
            F.when(F.col("segment") == n - 1, F.col("end_ts"))
            .otherwise(F.col("start_ts") + (F.col("segment") + 1) * F.col("step")).alias("end_ts"),
        )
    )


def segment_bounds(start: int, end: int, n: int) -> list[tuple[int, int]]:
    """The same split for limits known on the driver, as scan predicates need them."""
    step = (end - start) // n
    return [(start + i * step, end if i == n - 1 else start + (i + 1) * step) for i in range(n)]


def in_segment(bounds: tuple[int, int], ts: str = "timestamp") -> Column:
    return (F.col(ts) > bounds[0]) & (F.col(ts) <= bounds[1])


def segment_of(start: int, end: int, n: int, ts: str = "timestamp") -> Column:
    """Segment number of a row in the split of ``segment_bounds``, by arithmetic: no join.

    A range of fewer than n seconds has steps of 0, so all of it is the last segment.
    """
    step = (end - start) // n
    raw = F.expr(f"({ts} - {start} - 1) div {step}") if step else F.lit(n - 1)
    inside = (F.col(ts) > start) & (F.col(ts) <= end)
    return F.when(inside, F.least(raw, F.lit(n - 1)).cast("int"))


def merge_segments(*parts: DataFrame) -> DataFrame:
    """Union of separately fetched ranges; rows fetched twice at a boundary collapse."""
    return dedup_fills(reduce(DataFrame.unionByName, parts))


def ingest_counts(fills: DataFrame, start: int, end: int, n: int) -> DataFrame:
    """Records, distinct ids and time range per segment, so that a gap cannot pass silently.

    Ids are counted after one pass per (segment, id); no segment is held in one task.
    """
    per_id = (
        fills.withColumn("segment", segment_of(start, end, n))
        .groupBy("segment", "id")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("timestamp").alias("lo"),
             F.max("timestamp").alias("hi"))
    )
    return per_id.groupBy("segment").agg(
        F.sum("copies").alias("records"),
        F.count(F.lit(1)).alias("ids"),
        F.min("lo").alias("first_ts"),
        F.max("hi").alias("last_ts"),
    )


def row_count(rows: DataFrame) -> DataFrame:
    """Number of non-empty rows: the offset at which the next listing request starts."""
    filled = F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in rows.columns])
    return rows.filter(filled.isNotNull()).agg(F.count(F.lit(1)).alias("row_count"))


def high_water_mark(fills: DataFrame) -> DataFrame:
    """The last (timestamp, id) that the target holds."""
    return fills.agg(F.max(F.struct("timestamp", "id")).alias("last")).select(
        F.col("last.timestamp").alias("last_timestamp"), F.col("last.id").alias("last_id"),
        epoch_text(F.col("last.timestamp")).alias("last_time"))


def safe_high_water_mark(fills: DataFrame) -> DataFrame:
    """The last second that is surely complete, and the open second after it.

    The newest second may have been cut by the end of a page, so it stays open until the next
    run. With a single second there is no safe one: the cursor stays on it.
    """
    newest = (
        fills.groupBy("timestamp").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("id"))
        .orderBy(F.col("timestamp").desc()).limit(2)
    )
    return newest.agg(
        F.max("timestamp").alias("open_timestamp"),
        F.max_by("n", "timestamp").alias("open_rows"),
        F.max_by("id", "timestamp").alias("open_last_id"),
        F.nullif(F.min("timestamp"), F.max("timestamp")).alias("safe_timestamp"),
    )
