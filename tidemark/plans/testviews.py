"""Prediction-market tables over the TPC-H-like test tables (the mapping of FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.fills import PLATFORM_WALLETS
from tidemark.schemas import MARKETS
from tidemark.sources.commits import Folder

DAY = 86_400
DEALT_BYTES = 16 << 20  # of a table's files per partition, where rows are dealt out by a key
#: The same where fills with all their text are sorted, 20 or 30 times the table's bytes.
SORTED_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt_parts(spark: SparkSession, sf_dir: str, name: str, each: int = 0) -> int:
    """Partitions to deal a table out to: the session's number, or more where its files are larger
    than so many times ``each`` bytes (else ``DEALT_BYTES``), so that what a task sorts does not grow
    with the table."""
    size = sum(n for _, n, _ in Folder(spark, f"{sf_dir}/{name}.parquet").stamps())
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (each or DEALT_BYTES)))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a zone-less timestamp."""
    days = F.datediff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    return days * DAY + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def _id8(prefix: str, key: str) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), 8, "0"))


def _token(number: Column) -> Column:
    return F.concat(F.lit("7"), F.lpad(number.cast("string"), 76, "0"))


def landed_fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fills as they land: rows of line 7 arrive twice."""
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1970-01-01").cast("date"))
    # the three as small values: less to shuffle
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        F.col("l_quantity").cast("long").alias("quantity"),
        (F.col("l_linestatus") == "O").alias("maker_pays"), day.alias("day"))
    # dealt out by the join's key: a file may be one split
    line = line.repartition(dealt_parts(spark, sf_dir, "lineitem"), "l_orderkey")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    token = _token(F.col("l_partkey") * 2 + 1 + F.col("l_linenumber") % 2)
    quantity, maker_pays = F.col("quantity"), F.col("maker_pays")
    token_units = quantity * 1_000_000
    usd_units = quantity * 10_000 * F.expr(
        "1 + (l_partkey * 37 + l_orderkey * 11 + l_linenumber * 5) % 99")
    copies = F.when(F.col("l_linenumber") == 7, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    return (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            (F.col("day").cast("long") * DAY + F.expr(
                "(l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31 + l_suppkey * 17)"
                " % 86400")).alias("timestamp"),
            _id8("0xm", "l_suppkey").alias("maker"),
            F.when(maker_pays, F.lit("0")).otherwise(token).alias("makerAssetId"),
            F.when(maker_pays, usd_units).otherwise(token_units).alias("makerAmountFilled"),
            F.when(F.col("o_custkey") % 10 == 0, F.lit(PLATFORM_WALLETS[1]))
            .otherwise(_id8("0xt", "o_custkey")).alias("taker"),
            F.when(maker_pays, token).otherwise(F.lit("0")).alias("takerAssetId"),
            F.when(maker_pays, token_units).otherwise(usd_units).alias("takerAmountFilled"),
            F.concat(F.lit("0xh"), F.col("l_orderkey").cast("string")).alias("transactionHash"),
            F.explode(copies).alias("copy"),
        )
        .drop("copy")
    )


def _market_rows(part: DataFrame, question: Column) -> DataFrame:
    key = F.col("p_partkey")
    return part.select(
        F.concat(F.lit("2024-01-"), F.lpad((key % 28 + 1).cast("string"), 2, "0"),
                 F.lit("T00:00:00Z")).alias("createdAt"),
        key.cast("string").alias("id"),
        question.alias("question"),
        F.lit("Yes").alias("answer1"),
        F.lit("No").alias("answer2"),
        (F.col("p_size") % 2 == 0).alias("neg_risk"),
        F.translate("p_name", " ", "-").alias("market_slug"),
        _token(key * 2 + 1).alias("token1"),
        _token(key * 2 + 2).alias("token2"),
        F.concat(F.lit("0xc"), key.cast("string")).alias("condition_id"),
        F.col("p_retailprice").alias("volume"),
        F.col("p_brand").alias("ticker"),
        F.lit(None).cast("string").alias("closedTime"),
    ).select(*MARKETS.fieldNames())


def main_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").filter("p_partkey % 50 <> 7")
    return _market_rows(part, F.col("p_name"))


def late_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").filter("p_partkey % 100 = 7 OR p_partkey % 40 = 3")
    return _market_rows(part, F.concat("p_name", F.lit(" (late)")))


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five price series, one per event type, shaped like trades."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("market_id"),
        F.timestamp_seconds(epoch_seconds(F.col("ts"))).alias("timestamp"),
        F.col("event_id").alias("id"),
        F.lit("token1").alias("nonusdc_side"),
        (F.col("value") / 1000).alias("price"),
        F.col("value").alias("usd_amount"),
    )


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third supplier as a listed wallet; names ending in 0 belong to wallets that never traded."""
    supplier = table(spark, sf_dir, "supplier").filter("s_suppkey % 3 = 0")
    wallet = F.when(F.col("s_suppkey") % 10 == 0, _id8("0xz", "s_suppkey")).otherwise(
        _id8("0xm", "s_suppkey"))
    return supplier.select(wallet.alias("user_id"), F.col("s_name").alias("user_name"))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, series, timestamp, value): ten runs of five series with gaps; some values are NaN.

    One row per (run, series, 10 minutes): the newest event of the slot.
    """
    ev = table(spark, sf_dir, "events")
    seconds = epoch_seconds(F.col("ts"))
    value = F.when(F.col("event_id") % 13 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return (
        ev.select(
            F.concat(F.lit("run"), (F.col("user_id") % 10).cast("string")).alias("run_id"),
            F.col("event_type").alias("series"),
            F.timestamp_seconds(seconds - seconds % 600).alias("timestamp"),
            F.struct(seconds.alias("s"), "event_id", value.alias("value")).alias("e"))
        .groupBy("run_id", "series", "timestamp")
        .agg(F.max("e").alias("e"))
        .select("run_id", "series", "timestamp", "e.value")
    )
