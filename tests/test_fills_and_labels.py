"""Hand-made fills, markets and landed responses."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import fills as FL
from tidemark.operators import labelling as L
from tidemark.operators import markets as M
from tidemark.operators import pricing as P
from tidemark.operators import upsert as U
from tidemark.sources import landed, readers, writers


def fill(ident, maker_asset, maker_amount, taker_asset, taker_amount, ts=100):
    return (ident, ts, "0xm", maker_asset, maker_amount, "0xt", taker_asset, taker_amount, "0xh")


def market(ident, token1, token2, question="q", created="2024", slug="s"):
    row = dict.fromkeys(schemas.MARKETS.fieldNames())
    row.update(id=ident, token1=token1, token2=token2, question=question, createdAt=created,
               market_slug=slug)
    return tuple(row.values())


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame(
        [market("m1", "T1", "T2"), market("m2", "T3", "")], schemas.MARKETS)


def labelled(spark, known, *rows):
    fills = spark.createDataFrame(list(rows), schemas.FILLS)
    return {r["id"]: r for r in L.label_trades(fills, known).collect()}


def test_label_cases(spark, known):
    got = labelled(
        spark, known,
        fill("buy", "0", 600_000, "T1", 1_000_000),
        fill("sell", "T2", 2_000_000, "0", 500_000),
        fill("maker-unknown", "X", 1_000_000, "0", 400_000),
        fill("taker-unknown", "0", 400_000, "X", 1_000_000),
        fill("swap", "T1", 1_000_000, "T2", 1_000_000),
        fill("cash", "0", 1_000_000, "0", 1_000_000),
        fill("zero", "0", 600_000, "T1", 0))
    def brief(name):
        r = got[name]
        return (r["market_id"], r["nonusdc_side"], r["maker_direction"], r["taker_direction"],
                r["price"], r["usd_amount"], r["token_amount"], r["is_matched"])
    assert brief("buy") == ("m1", "token1", "BUY", "SELL", 0.6, 0.6, 1.0, True)
    assert brief("sell") == ("m1", "token2", "SELL", "BUY", 0.25, 0.5, 2.0, True)
    assert brief("maker-unknown") == (None, "USDC", "SELL", "BUY", 0.4, 0.4, 1.0, False)
    assert brief("taker-unknown") == (None, None, "BUY", "SELL", 0.4, 0.4, 0.4, False)
    assert brief("swap") == ("m1", "token1", "BUY", "SELL", 1.0, 1.0, 1.0, True)
    assert brief("cash")[:4] == (None, "USDC", "SELL", "BUY")
    assert got["zero"]["price"] is None and got["zero"]["token_amount"] == 0.0


def test_quality_report(spark, known):
    fills = spark.createDataFrame([
        fill("a", "T1", 1, "T2", 1), fill("b", "0", 1, "0", 1), fill("c", "0", 1, "T1", 0),
        fill("d", "X", 1, "0", 1), fill("e", "0", 1, "X", 1)], schemas.FILLS)
    got = {r["check"]: r["rows"] for r in L.quality_report(fills, known).collect()}
    assert got == {"fills": 5, "token_swaps": 1, "cash_swaps": 1, "zero_amounts": 1,
                   "unmatched_maker_tokens": 2, "unmatched_taker_tokens": 1, "shared_tokens": 0}
    twice = known.unionByName(spark.createDataFrame([market("m9", "T1", "T9")], schemas.MARKETS))
    got = {r["check"]: r["rows"] for r in L.quality_report(fills, twice).collect()}
    assert got["shared_tokens"] == 1


def test_markets_keep_first_and_empty_tokens(spark):
    main = spark.createDataFrame([
        market("1", "a", "b", "main late slug", "2024-02"), market("1", "a", "b", "main", "2024-01"),
        market("3", "e", "")], schemas.MARKETS)
    late = spark.createDataFrame([
        market("1", "x", "y", "late", "2020"), market("2", "c", "d", "only late")], schemas.MARKETS)
    rows = M.by_creation(M.combine_markets(main, late)).collect()
    assert [(r["id"], r["question"]) for r in rows] == [
        ("2", "only late"), ("3", "q"), ("1", "main")]
    tokens = {r["asset_id"] for r in M.markets_long(M.combine_markets(main, late)).collect()}
    assert tokens == {"a", "b", "c", "d", "e"}
    fresh = M.new_markets(late, main).collect()
    assert [r["id"] for r in fresh] == ["2"]


def test_find_market_order(spark):
    rows = [("a", "red x", 5.0), ("b", "red y", 1.0), ("c", "blue", 0.1)]
    df = spark.createDataFrame(rows, "id string, question string, volume double")
    assert M.find_market(df, "^red").head()["id"] == "b"
    assert M.find_market(df, "^red", descending=True).head()["id"] == "a"


def test_last_price_snaps_strictly(spark):
    rows = [("m", s, i, p) for i, (s, p) in enumerate(
        [("a", 0.98), ("b", 0.981), ("c", 0.02), ("d", 0.019), ("e", 0.5)])]
    df = spark.createDataFrame(
        rows, "market_id string, nonusdc_side string, timestamp long, price double")
    df = df.withColumn("id", F.col("timestamp").cast("string"))
    got = {r["side"]: r["last_price"] for r in P.last_price(df).collect()}
    assert got == {"a": 0.98, "b": 1.0, "c": 0.02, "d": 0.0, "e": 0.5}


def test_dedup_takes_smallest_row_whatever_the_order(spark):
    rows = [fill("a", "0", 5, "T1", 1, ts=7), fill("a", "0", 3, "T1", 1, ts=7),
            fill("a", "0", 9, "T1", 1, ts=8), fill("b", "0", 1, "T1", 1)] * 3
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, schemas.FILLS).repartition(3)
        got = {r["id"]: r["makerAmountFilled"] for r in FL.dedup_fills(df).collect()}
        assert got == {"a": 3, "b": 1}


def test_segments_cover_and_merge(spark, tiny):
    from tidemark.plans import testviews as V
    fills = V.landed_fills(spark, tiny)
    lo, hi = fills.agg(F.min("timestamp"), F.max("timestamp")).head()
    bounds = FL.segment_bounds(lo - 1, hi, 7)
    assert bounds[0][0] == lo - 1 and bounds[-1][1] == hi
    assert all(a[1] == b[0] for a, b in zip(bounds, bounds[1:]))
    parts = [fills.filter(FL.in_segment(b)) for b in bounds]
    merged = FL.merge_segments(*parts)
    whole = FL.dedup_fills(fills)
    assert merged.exceptAll(whole).isEmpty() and whole.exceptAll(merged).isEmpty()
    frame = spark.createDataFrame([(lo - 1, hi)], "start_ts long, end_ts long")
    assert [(r["start_ts"], r["end_ts"]) for r in
            FL.time_segments(frame, 7).orderBy("segment").collect()] == bounds
    per = {r["segment"]: r["records"] for r in
           FL.ingest_counts(fills, lo - 1, hi, 7).collect()}
    assert per == {i: p.count() for i, p in enumerate(parts)}


def test_safe_high_water_mark(spark):
    df = spark.createDataFrame(
        [fill("a", "0", 1, "T", 1, 5), fill("b", "0", 1, "T", 1, 9), fill("c", "0", 1, "T", 1, 9)],
        schemas.FILLS)
    r = FL.safe_high_water_mark(df).head()
    assert (r["open_timestamp"], r["open_rows"], r["safe_timestamp"]) == (9, 2, 5)
    one = FL.safe_high_water_mark(df.filter("timestamp = 9")).head()
    assert one["safe_timestamp"] is None and one["open_last_id"] == "c"


PAGE = [
    {"id": 7, "question": "", "title": "fallback", "outcomes": "[]", "clobTokenIds": '["11"]',
     "volume": "3.5", "negRiskOther": True},
    {"id": "8", "question": "q", "outcomes": ["Up", "Down"], "clobTokenIds": ["21", "22"],
     "events": [{"ticker": "tk"}], "volume": 4},
    {"id": "9", "question": "bad", "outcomes": "[broken", "clobTokenIds": "[]"},
]


def test_parse_markets_modes(spark):
    pages = spark.createDataFrame([(json.dumps(PAGE),)], "value string")
    bulk = {r["id"]: r for r in landed.parse_markets(pages).collect()}
    assert set(bulk) == {"7", "8"}
    seven, eight = bulk["7"], bulk["8"]
    assert (seven["question"], seven["answer1"], seven["token1"], seven["token2"],
            seven["neg_risk"], seven["volume"], seven["ticker"]) == (
                "fallback", "", "11", "", True, 3.5, "")
    assert (eight["answer1"], eight["answer2"], eight["token2"], eight["ticker"],
            eight["neg_risk"], eight["volume"]) == ("Up", "Down", "22", "tk", False, 4.0)
    singles = spark.createDataFrame([(json.dumps([m]),) for m in PAGE], "value string")
    by_token = landed.parse_markets(singles, "by_token").collect()
    assert [r["id"] for r in by_token] == ["8"]  # one token is too few
    two = [{"id": "5", "clobTokenIds": '["1","2"]'}, PAGE[1]]
    only = landed.parse_markets(
        spark.createDataFrame([(json.dumps(two),)], "value string"), "by_token").collect()
    assert [(r["id"], r["answer1"], r["answer2"]) for r in only] == [("5", "YES", "NO")]


def test_parse_events(spark):
    token = "7" + "1" * 75
    page = {"data": {"orderFilledEvents": [
        {"id": "a", "timestamp": "5", "maker": "m", "makerAmountFilled": "10",
         "makerAssetId": token, "taker": "t", "takerAmountFilled": "20", "takerAssetId": "0",
         "transactionHash": "h", "fee": "0"}]}}
    df = spark.createDataFrame([(json.dumps(page),), ('{"data":{"orderFilledEvents":[]}}',)],
                               "value string")
    assert [tuple(r) for r in landed.parse_events(df).collect()] == [
        ("a", 5, "m", token, 10, "t", "0", 20, "h")]


def test_sources_round_trip(spark, tmp_path):
    token = "9" * 76
    rows = spark.createDataFrame([market("1", token, "b", 'a "quoted", name')], schemas.MARKETS)
    rows.coalesce(1).write.option("header", True).option("escape", '"').csv(str(tmp_path / "m.csv"))
    got = readers.get_markets(spark, str(tmp_path / "m.csv"), str(tmp_path / "absent.csv"))
    assert [(r["token1"], r["question"]) for r in got.collect()] == [(token, 'a "quoted", name')]
    assert readers.get_markets(spark, None).count() == 0
    fills = spark.createDataFrame([fill("a", "0", 1, "T", 1, 86_400 * 3)], schemas.FILLS)
    writers.write_fills(fills, str(tmp_path / "fills"))
    assert readers.read_fills(spark, str(tmp_path / "fills")).collect() == fills.collect()


def test_stored_trades_prune_by_date(spark, known, tmp_path):
    fills = spark.createDataFrame(
        [fill(str(i), "0", 1, "T1", 2, 86_400 * i) for i in range(4)], schemas.FILLS)
    trades = L.label_trades(fills, known)
    writers.write_trades(trades, str(tmp_path / "t"))
    back = readers.read_trades(spark, str(tmp_path / "t"))
    assert sorted(map(str, back.collect())) == sorted(map(str, trades.collect()))
    day = readers.read_trades(spark, str(tmp_path / "t"), dates=("1970-01-03", "1970-01-03"))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and day.count() == 1


def test_short_ranges_have_one_segment_formula(spark):
    """Both forms of the split agree, also where there are fewer seconds than parts."""
    for start, end, n in ((0, 3, 5), (0, 5, 5), (0, 17, 5), (10, 11, 3)):
        bounds = FL.segment_bounds(start, end, n)
        rows = spark.range(start - 1, end + 3).withColumnRenamed("id", "timestamp")
        for r in rows.withColumn("s", FL.segment_of(start, end, n)).collect():
            own = [i for i, (a, b) in enumerate(bounds) if a < r["timestamp"] <= b]
            assert own == ([] if r["s"] is None else [r["s"]]), (start, end, n, r)


def test_upsert_takes_whole_rows(spark):
    schema = "market_id string, timestamp long, open double, close double"
    old = spark.createDataFrame([("a", 1, 1.0, 1.0)], schema)
    new = spark.createDataFrame([("a", 1, 5.0, 2.0), ("a", 1, 4.0, 9.0), ("b", 2, None, 3.0)], schema)
    got = {tuple(r) for r in U.upsert_bars(old, new).collect()}
    assert got == {("a", 1, 5.0, 2.0), ("b", 2, None, 3.0)}


def test_bad_fields_are_loud(spark, tmp_path):
    path = str(tmp_path / "fills.csv")
    names = schemas.FILLS.fieldNames()
    with open(path, "w") as f:
        f.write(",".join(names) + "\na,1,m,0,5,t,7,10,h\nb,1,m,0,12x,t,7,10,h\n")
    assert readers.read_fills(spark, path).count() == 2
    counts = {r["check"]: r["rows"] for r in
              readers.rejected_fields(spark, path, schemas.FILLS).collect()}
    assert counts == {"rows": 2, "rows_with_bad_fields": 1}
    with pytest.raises(Exception):
        readers.read_fills(spark, path, on_bad="fail").collect()
    with pytest.raises(ValueError):
        readers.read_fills(spark, path, on_bad="skip")
