"""Stored cursors, bounds from folders, counts of a write, lookups by id and by wallet."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import fills as FL, labelling as L
from tidemark.plans import registry
from tidemark.sources import bounds as B, cursors as C, ids as I
from tidemark.sources.commits import KEEP, Folder, commit, committed
from tidemark.sources.readers import read_trades
from tidemark.sources.writers import counts_of, observed, write_fills, write_trades


def test_a_log_keeps_its_newest_whole_entries(spark, tmp_path):
    path = str(tmp_path / "log")
    assert list(committed(spark, path)) == []
    for i in range(KEEP + 5):
        assert commit(spark, path, {"n": i}) == i
    assert [s["n"] for s in committed(spark, path)] == list(range(KEEP + 4, 4, -1))
    last = sorted((tmp_path / "log").glob("*.json"))[-1]
    for text in ("", "{", "[]", '{"state": {"n": 99}, "crc32": 1}', last.read_text()[:-3]):
        (tmp_path / "log" / f".{last.name}.crc").unlink(missing_ok=True)
        last.write_text(text)
        assert next(committed(spark, path))["n"] == KEEP + 3
    assert commit(spark, path, {"n": -1}) == KEEP + 5
    assert next(committed(spark, path)) == {"n": -1}
    with pytest.raises(Exception):
        Folder(spark, path).write(last.name, "again")


@pytest.mark.parametrize("state, cursor", [
    ({"last_timestamp": 7, "last_id": "a", "sticky_timestamp": 8}, C.Cursor(7, "a", 8)),
    ({"last_timestamp": 7, "last_id": None, "sticky_timestamp": 8}, C.Cursor(7)),
    ({"last_timestamp": 7, "last_id": "a", "sticky_timestamp": None}, C.Cursor(7)),
    ({"last_timestamp": 0, "last_id": None, "sticky_timestamp": None}, C.Cursor(39)),
    ({"last_timestamp": "7", "last_id": None, "sticky_timestamp": None}, C.Cursor(39)),
    ({"last_timestamp": -3, "last_id": "a", "sticky_timestamp": 8}, C.Cursor(39)),
    ({"last_timestamp": 0, "last_id": "a", "sticky_timestamp": 8}, C.Cursor(0, "a", 8)),
    ({}, C.Cursor(39))])
def test_a_cursor_is_checked(spark, tmp_path, state, cursor):
    path, held = str(tmp_path / "log"), spark.createDataFrame([("x", 40)], "id string, timestamp long")
    commit(spark, path, state)
    assert C.load_cursor(spark, path, held) == cursor


def test_older_entries_and_data_stand_in(spark, tmp_path):
    path, held = str(tmp_path / "log"), spark.createDataFrame([("x", 40)], "id string, timestamp long")
    C.save_cursor(spark, path, C.Cursor(30))
    C.save_cursor(spark, path, C.Cursor(0))
    assert C.load_cursor(spark, path, held) == C.Cursor(30)
    assert C.load_cursor(spark, str(tmp_path / "none"), held) == C.Cursor(39)
    assert C.load_cursor(spark, str(tmp_path / "none"), held.limit(0)) == C.Cursor()
    assert C.load_cursor(spark, str(tmp_path / "none")) == C.Cursor()


def test_pages_give_every_fill_once(spark):
    """A feed read page by page, where a second is longer than a page."""
    feed = [(f"{i:03}", t) for i, t in enumerate([5, 5, 5, 5, 5, 6, 7, 7, 9, 9, 9, 9])]
    rows = spark.createDataFrame(feed, "id string, timestamp long")
    cursor, seen = C.Cursor(), []
    for _ in range(20):
        page = rows.filter(cursor.wanted()).orderBy("timestamp", "id").limit(2).cache()
        seen += [(r["id"], r["timestamp"]) for r in page.collect()]
        after = cursor.after(page, 2)
        if after == cursor:
            break
        cursor = after
    assert seen == feed and cursor == C.Cursor(9)


def test_marks_read_only_the_newest_folders(spark, tmp_path):
    rows = [(f"i{t}", t, "m", "0", 1, "t", "7", 1, "h") for t in (100, 90_000, 200_000, 200_000, 200_007)]
    schema = ("id string, timestamp long, maker string, makerAssetId string, makerAmountFilled long, "
              "taker string, takerAssetId string, takerAmountFilled long, transactionHash string")
    path = str(tmp_path / "fills")
    write_fills(spark.createDataFrame(rows, schema), path)
    assert B.stored_dates(spark, path) == ["1970-01-01", "1970-01-02", "1970-01-03"]
    for old in ("1970-01-01", "1970-01-02"):  # whoever opens these fails
        for file in (tmp_path / "fills" / f"date={old}").glob("*.parquet"):
            file.write_bytes(b"broken")
            (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    safe = B.stored_safe_mark(spark, path).first()
    assert (safe["open_timestamp"], safe["safe_timestamp"], safe["open_rows"]) == (200_007, 200_000, 1)
    assert B.stored_high_water_mark(spark, path).first()["last_timestamp"] == 200_007


def test_a_single_second_widens_to_older_folders(spark, tmp_path):
    rows = [("a", 100), ("b", 200_000), ("c", 200_000)]
    fills = spark.createDataFrame(rows, "id string, timestamp long")
    for c in ("maker", "makerAssetId", "taker", "takerAssetId", "transactionHash"):
        fills = fills.withColumn(c, F.lit("0"))
    for c in ("makerAmountFilled", "takerAmountFilled"):
        fills = fills.withColumn(c, F.lit(1).cast("long"))
    write_fills(fills, str(tmp_path / "two"))
    got = B.stored_safe_mark(spark, str(tmp_path / "two")).first()
    assert (got["open_timestamp"], got["safe_timestamp"], got["open_rows"]) == (200_000, 100, 2)
    write_fills(fills.filter("timestamp > 100"), str(tmp_path / "one"))
    assert B.stored_safe_mark(spark, str(tmp_path / "one")).first()["safe_timestamp"] is None


def test_a_write_counts_itself(spark, tiny, tmp_path):
    landed = registry.V.landed_fills(spark, tiny)
    bounds = FL.segment_bounds(*registry.time_bounds(landed), 3)
    watch = write_fills(landed, str(tmp_path / "f"), unit="year", segments=[FL.in_segment(b) for b in bounds])
    got = {r["segment"]: r["records"] for r in counts_of(spark, watch).collect()}
    assert got == {-1: landed.count(), **{i: landed.filter(FL.in_segment(b)).count() for i, b in enumerate(bounds)}}
    rows, watch = observed(landed.limit(0))
    rows.write.parquet(str(tmp_path / "none"))
    assert [tuple(r) for r in counts_of(spark, watch).collect()] == [(-1, 0, None, None)]


def nodes(plan):
    """All operators of a physical plan, before adaptive execution changes it."""
    todo = [plan]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.initialPlan()
        yield node
        todo += [node.children().apply(i) for i in range(node.children().size())]


def test_stored_ids_stay_where_they_are(spark, tiny, tmp_path):
    """The lookup shuffles the new rows alone."""
    fills, path = registry.fills(spark, tiny), str(tmp_path / "ids")
    first = fills.filter("timestamp < 900000000")
    assert I.new_rows(fills, path, 8).count() == fills.count()
    I.add_ids(first, path, 8)
    new = I.new_rows(fills, path, 8)
    joins = [n for n in nodes(new._jdf.queryExecution().executedPlan()) if "Join" in n.nodeName()]
    stored = [n.nodeName() for n in nodes(joins[0].children().apply(1))]
    assert any("Scan" in n for n in stored) and not any("Exchange" in n for n in stored)
    assert any("Exchange" in n.nodeName() for n in nodes(joins[0].children().apply(0)))
    want = fills.join(first.select("id"), "id", "left_anti")
    assert new.count() == want.count() and new.select("id").exceptAll(want.select("id")).isEmpty()
    I.add_ids(new, path, 8)
    assert I.new_rows(fills, path, 8).isEmpty()


def rows_scanned(df):
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            node = node.executedPlan()
        if "Scan" in node.nodeName():
            total += node.metrics().apply("numOutputRows").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_absent_wallets_skip_row_groups(spark, tiny, tmp_path):
    trades = L.label_trades(registry.fills(spark, tiny), registry.markets(spark, tiny))
    hadoop, path = spark.sparkContext._jsc.hadoopConfiguration(), str(tmp_path / "t")
    hadoop.set("parquet.enable.dictionary", "false")  # so that dictionaries cannot tell
    try:
        write_trades(trades, path, unit="year")
    finally:
        hadoop.unset("parquet.enable.dictionary")
    stored = read_trades(spark, path)
    for column in ("maker", "taker"):
        present = stored.agg(F.min(column)).head()[0]
        assert rows_scanned(stored.filter(F.col(column) == present)) > 0
        assert rows_scanned(stored.filter(F.col(column) == present + "0")) == 0
