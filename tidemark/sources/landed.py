"""Landed JSON responses to rows.

A response is one text value: a JSON array of market objects, or one page of events.
:func:`read_pages` reads files of them; the listing service caps a page at 500 markets or 1000
events, which bounds the text of one row. The ``rejected_`` functions count what the parsers
leave out.

Market objects are read as variants: no schema fixes what else an object may hold, and a field may
be text, a number or a list from one listing to the next. A page is read as a whole or not at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import first_filled, item, json_list

# Answers of a market that names none, per parser mode.
DEFAULT_ANSWERS = {"bulk": ("", ""), "by_token": ("YES", "NO")}


def read_pages(spark: SparkSession, path: str, layout: str = "files") -> DataFrame:
    """Landed responses as column ``value``: one per file, or one per line (``text``)."""
    if layout not in ("files", "text"):
        raise ValueError(f"unknown layout {layout!r}")
    return spark.read.text(path, wholetext=layout == "files")


def _objects(column: str) -> Column:
    """The objects of a page as variants; null where the page is no JSON array."""
    return F.try_variant_get(F.try_parse_json(F.col(column)), "$", "array<variant>")


def _field(market: Column, name: str, kind: str = "string") -> Column:
    """A field of a market object, null where it is absent or of another kind. As text, a number is
    its digits and a list its JSON."""
    return F.try_variant_get(market, f"$.{name}", kind)


def rejected_markets(pages: DataFrame, column: str = "value") -> DataFrame:
    """Pages that are no JSON array and objects with malformed lists, as (check, rows)."""
    parsed = pages.select(_objects(column).alias("p"), F.col(column).alias("raw"))
    broken = F.col("raw").isNotNull() & F.col("p").isNull()

    def bad(m: Column) -> Column:
        return json_list(_field(m, "outcomes")).isNull() | json_list(_field(m, "clobTokenIds")).isNull()
    objects = F.when(~broken, F.size(F.filter("p", bad))).otherwise(0)
    counts = parsed.agg(F.count_if(broken).alias("broken_market_pages"),
                        F.coalesce(F.sum(objects), F.lit(0)).alias("rejected_markets"))
    return counts.unpivot([], counts.columns, "check", "rows")


def rejected_events(pages: DataFrame, column: str = "value") -> DataFrame:
    """Pages without a readable list of events, as (check, rows)."""
    raw = F.col(column)
    events = F.from_json(raw, schemas.EVENT_PAGE_JSON)["data"]["orderFilledEvents"]
    broken = raw.isNotNull() & (events.isNull() | _cut_off(raw, "{", "}"))
    return pages.agg(F.count_if(broken).alias("broken_event_pages")).unpivot(
        [], ["broken_event_pages"], "check", "rows")


def _cut_off(raw: Column, opens: str, closes: str) -> Column:
    """Whether a response does not start and end as a whole one does."""
    text = F.trim(raw)
    return ~(text.startswith(opens) & text.endswith(closes))


def parse_markets(pages: DataFrame, mode: str = "bulk", column: str = "value") -> DataFrame:
    """Market rows from landed pages.

    ``bulk`` takes every object of a page and lets tokens and answers be absent. ``by_token``
    takes the first object, needs two tokens, and names missing answers YES and NO. Objects
    whose outcomes or tokens are malformed JSON are left out.
    """
    if mode not in DEFAULT_ANSWERS:
        raise ValueError(f"unknown mode {mode!r}")
    objects = _objects(column)
    if mode == "by_token":
        objects = F.slice(objects, 1, 1)
    yes, no = DEFAULT_ANSWERS[mode]
    market = F.col("market")
    markets = pages.select(F.explode(objects).alias("market")).withColumns({
        "answers": json_list(_field(market, "outcomes")), "tokens": json_list(_field(market, "clobTokenIds"))})
    valid = F.col("answers").isNotNull() & F.col("tokens").isNotNull()
    if mode == "by_token":
        valid = valid & (F.size("tokens") >= 2)

    def text(name: str) -> Column:
        return F.coalesce(_field(market, name), F.lit(""))

    def flag(name: str) -> Column:
        return F.coalesce(_field(market, name, "boolean"), F.lit(False))
    return markets.filter(valid).select(
        text("createdAt").alias("createdAt"),
        text("id").alias("id"),
        first_filled(_field(market, "question"), _field(market, "title")).alias("question"),
        item(F.col("answers"), 0, yes).alias("answer1"),
        item(F.col("answers"), 1, no).alias("answer2"),
        (flag("negRiskAugmented") | flag("negRiskOther")).alias("neg_risk"),
        text("slug").alias("market_slug"),
        item(F.col("tokens"), 0, "").alias("token1"),
        item(F.col("tokens"), 1, "").alias("token2"),
        text("conditionId").alias("condition_id"),
        _field(market, "volume").try_cast("double").alias("volume"),
        text("events[0].ticker").alias("ticker"),
        text("closedTime").alias("closedTime"),
    )


def parse_events(pages: DataFrame, column: str = "value") -> DataFrame:
    """Fill rows from landed event pages: nested objects flat, numeric text as numbers."""
    page = F.from_json(F.col(column), schemas.EVENT_PAGE_JSON)
    events = pages.select(F.inline(page["data"]["orderFilledEvents"]))
    return events.select(*[
        F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.FILLS.fields])
