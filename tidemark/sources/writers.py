"""Table layouts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from tidemark import schemas
from tidemark.functions.text import day_of
from tidemark.operators.labelling import label_trades
from tidemark.session import stage


#: Columns of a trade that rows are looked up by.
LOOKED_UP = ("market_id", "maker", "taker")


def with_blooms(writer: DataFrameWriter, columns: Sequence[str]) -> DataFrameWriter:
    """Let every row group say which values of ``columns`` it cannot hold, in a filter as large as
    the values it holds ask for."""
    writer = (writer.option("parquet.bloom.filter.adaptive.enabled", "true")
              .option("parquet.bloom.filter.candidates.number", "10"))
    for column in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer


#: Order of trades within a file.
TRADE_ORDER = ("date", "market_id", "maker", "id")
TRADES_CODEC = "zstd"  # fewer bytes than snappy


def write_trades(trades: DataFrame, path: str, mode: str = "append", unit: str = "day",
                 ranged: bool = True) -> None:
    """Trades by date, clustered by market and maker within a date.

    Ranges over (date, market, maker, id) give files of even size: a busy date or market is
    split over many tasks. Statistics and Bloom filters in the files let a search for a market or a
    wallet, on either side, skip what cannot hold it.

    ``ranged=False`` writes every task's rows where they are, in the same order, and saves the
    shuffle of whole rows: for trades that come dealt out by token, as
    :func:`tidemark.operators.labelling.label_by_token` gives them. Each task then has a file per
    date, so that the dates should be few (months or years).
    """
    dated = trades.withColumn("date", day_of(F.col("timestamp"), unit))
    placed = dated.repartitionByRange(*TRADE_ORDER) if ranged else dated
    _write_by_date(placed, path, mode)


def _write_by_date(trades: DataFrame, path: str, mode: str, **options: str) -> None:
    writer = trades.sortWithinPartitions(*TRADE_ORDER).write.mode(mode).options(**options)
    with_blooms(writer, LOOKED_UP).partitionBy("date").parquet(path, compression=TRADES_CODEC)


def observed(rows: DataFrame, segments: Sequence[Column] = (), ts: str = "timestamp"
             ) -> tuple[DataFrame, Observation]:
    """``rows`` that count themselves as they are written or read, in the one pass of that action.

    :func:`counts_of` gives the figures afterwards: of all rows, and of those of each segment.
    """
    parts = [F.lit(True), *segments]
    seen = [f(F.when(part, F.col(ts))).alias(f"{name}{i}") for i, part in enumerate(parts)
            for name, f in (("records", F.count), ("first", F.min), ("last", F.max))]
    watch = Observation()
    return rows.observe(watch, *seen), watch


def counts_of(spark: SparkSession, watch: Observation) -> DataFrame:
    """segment (-1: all rows), records, first_ts and last_ts of an :func:`observed` action."""
    got = watch.get
    rows = [(i - 1, got[f"records{i}"], got[f"first{i}"], got[f"last{i}"]) for i in range(len(got) // 3)]
    return spark.createDataFrame(rows, "segment int, records long, first_ts long, last_ts long")


def write_fills(fills: DataFrame, path: str, mode: str = "append", unit: str = "day",
                segments: Sequence[Column] | None = None) -> Observation | None:
    """Raw fills by date of the event, in time order within a file.

    With ``segments`` (possibly none of them) the write counts what it writes, see
    :func:`counts_of`; the counting sits behind the last shuffle, where every row passes once.
    """
    dated = fills.withColumn("date", day_of(F.timestamp_seconds("timestamp"), unit))
    keys = ["date", "timestamp", "id"]
    ordered, watch = dated.repartitionByRange(*keys).sortWithinPartitions(*keys), None
    if segments is not None:
        ordered, watch = observed(ordered, segments)
    ordered.write.mode(mode).partitionBy("date").parquet(path)
    return watch


def rewrite_repaired(spark: SparkSession, path: str, fills: DataFrame, markets: DataFrame) -> int:
    """Label the unmatched trades of a table from ``write_trades`` again, now that more markets
    are known, and rewrite only the date folders that hold one found; returns their number.

    The driver sees the dates of repaired trades, which the calendar bounds. Only unmatched trades
    move; all others are written again by the task that reads them, unless one of them shares its
    id with a repaired trade, which replaces it. Fills from ``stage_buckets`` by id do not move
    either. Spark keeps the new files apart until all are written, so the folders may be read for them.
    """
    schema = StructType(list(schemas.TRADES.fields)).add("date", DateType())
    stored = spark.read.schema(schema).parquet(path)
    stale = stored.filter(~F.col("is_matched")).select("id", "date")
    again = label_trades(fills.join(stale.select("id"), "id", "left_semi"), markets)
    found = stage(again.filter("is_matched").join(stale, "id"), "repaired", TRADES_CODEC)
    dates = [r[0] for r in found.select("date").distinct().collect()]
    if not dates:
        return 0
    touched, ids = stored.filter(F.col("date").isin(dates)), found.select("id")
    waiting = touched.filter(~F.col("is_matched")).join(ids, "id", "left_anti")
    settled = touched.filter(F.coalesce("is_matched", F.lit(True)))
    # ids as hashes: few bytes to compare, and a wrong hit only costs the join by id
    code = F.xxhash64("id").alias("code")
    if not settled.select(code).join(ids.select(code), "code", "left_semi").isEmpty():
        settled = settled.join(ids, "id", "left_anti")
    kept = [df.select(*touched.columns) for df in (settled, waiting, found)]
    _write_by_date(reduce(DataFrame.unionByName, kept), path, "overwrite",
                   partitionOverwriteMode="dynamic")
    return len(dates)
