"""Readers with fixed schemas."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from tidemark import schemas
from tidemark.operators.markets import by_creation, combine_markets
from tidemark.sources.commits import Folder


def _format(path: str) -> str:
    name = path.rstrip("/").lower()
    for ending, fmt in ((".csv", "csv"), (".csv.gz", "csv"), (".json", "json"),
                        (".jsonl", "json"), (".orc", "orc")):
        if name.endswith(ending):
            return fmt
    return "parquet"


CORRUPT = "_corrupt_record"


def read_table(spark: SparkSession, path: str, schema: StructType, fmt: str | None = None,
               on_bad: str = "null") -> DataFrame:
    """A CSV, JSON lines, ORC or Parquet table under a declared schema.

    ``on_bad`` says what an unreadable field of a text format does: ``null`` leaves it null,
    ``keep`` also puts the whole line into a further column ``_corrupt_record``, ``fail`` stops
    the query. :func:`rejected_fields` counts such rows.
    """
    if on_bad not in ("null", "keep", "fail"):
        raise ValueError(f"unknown on_bad {on_bad!r}")
    fmt = fmt or _format(path)
    if on_bad == "keep" and fmt in ("csv", "json"):
        schema = StructType(list(schema.fields)).add(CORRUPT, "string")
    reader = spark.read.schema(schema)
    if fmt in ("csv", "json"):
        reader = reader.options(mode="FAILFAST" if on_bad == "fail" else "PERMISSIVE",
                                columnNameOfCorruptRecord=CORRUPT)
    if fmt == "csv":
        # an unreadable field becomes null instead of shifting the row
        reader = reader.options(header=True, escape='"', multiLine=False)
        return reader.option("enforceSchema", on_bad == "keep").csv(path)
    return reader.format(fmt).load(path)


def rejected_fields(spark: SparkSession, path: str, schema: StructType,
                    fmt: str | None = None) -> DataFrame:
    """Rows read and rows with an unreadable field, as (check, rows)."""
    rows = read_table(spark, path, schema, fmt, on_bad="keep")
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in rows.columns else F.lit(False)
    # a field that nobody reads is not parsed, so all of them enter the result
    counted = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("rows_with_bad_fields"),
        F.bit_or(F.xxhash64(*schema.fieldNames())).alias("seen"))
    counted = counted.filter(F.col("seen").isNotNull() | (F.col("rows") == 0)).drop("seen")
    return counted.unpivot([], counted.columns, "check", "rows")


def read_optional(spark: SparkSession, path: str | None, schema: StructType,
                  fmt: str | None = None) -> DataFrame:
    """The table, or an empty one with its schema where the path does not exist."""
    if path:
        try:
            return read_table(spark, path, schema, fmt)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return spark.createDataFrame([], schema)


def while_unchanged(spark: SparkSession, open_: Callable[[], DataFrame], *paths: str
                    ) -> Callable[[], DataFrame]:
    """``open_`` as a callable that opens again only when a file below ``paths`` was added, removed
    or replaced, and else gives the DataFrame it gave before."""
    last: list = [None, None]

    def current() -> DataFrame:
        now = [Folder(spark, path).stamps() for path in paths]
        if now != last[0]:
            last[:] = now, open_()
        return last[1]
    return current


def get_markets(spark: SparkSession, main: str | None, missing: str | None = None) -> DataFrame:
    """All known markets, one row per id, by creation. Either file may be absent."""
    return by_creation(combine_markets(
        read_optional(spark, main, schemas.MARKETS),
        read_optional(spark, missing, schemas.MARKETS)))


def _dated(spark: SparkSession, path: str, schema: StructType, fmt: str | None,
           dates: tuple[str, str] | None, on_bad: str = "null") -> DataFrame:
    full = StructType(list(schema.fields)).add("date", DateType()) if dates else schema
    return read_table(spark, path, full, fmt, on_bad)


def _within(df: DataFrame, schema: StructType, dates: tuple[str, str] | None) -> DataFrame:
    """Rows of the date folders in a range (inclusive), without the folder column."""
    if dates:
        df = df.filter(F.col("date").between(*[F.lit(d).cast("date") for d in dates]))
    return df.select(*schema.fieldNames())


def read_fills(spark: SparkSession, path: str, fmt: str | None = None,
               dates: tuple[str, str] | None = None, on_bad: str = "null") -> DataFrame:
    """Raw fills; ``dates`` reads only those folders of a table from ``write_fills``."""
    return _within(_dated(spark, path, schemas.FILLS, fmt, dates, on_bad), schemas.FILLS, dates)


def read_trades(spark: SparkSession, path: str, fmt: str | None = None,
                dates: tuple[str, str] | None = None) -> DataFrame:
    """Labelled trades; ``dates`` reads only those folders of a table from ``write_trades``."""
    return _within(_dated(spark, path, schemas.TRADES, fmt, dates), schemas.TRADES, dates)


def read_bars(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    return read_table(spark, path, schemas.BARS, fmt)


def read_leaderboard(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    return read_table(spark, path, schemas.LEADERBOARD, fmt)
