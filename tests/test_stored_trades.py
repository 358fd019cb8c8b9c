"""Stored trades: what moves when they are written and repaired, and that no row is lost."""

import pytest

from tidemark import schemas
from tidemark.operators import labelling as L
from tidemark.plans import registry
from tidemark.session import dealt, stage_buckets
from tidemark.sources import writers
from tidemark.sources.readers import read_trades


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def fill(ident, token, ts=100):
    return (ident, ts, "0xm", "0", 5, "0xt", token, 10, "0xh")


def markets_of(spark, **tokens):
    rows = []
    for ident, token in tokens.items():
        row = dict.fromkeys(schemas.MARKETS.fieldNames())
        row.update(id=ident, token1=token, token2="")
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, schemas.MARKETS)


@pytest.fixture
def written(monkeypatch):
    """Rows handed to the writer of date folders, as plans."""
    plans, write = [], writers._write_by_date

    def keep(trades, *args, **options):
        plans.append(physical(trades))
        write(trades, *args, **options)
    monkeypatch.setattr(writers, "_write_by_date", keep)
    return plans


def test_partitions_follow_the_block(spark):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with dealt(spark, int(before) + 3):
        assert spark.conf.get(key) == str(int(before) + 3)
    with dealt(spark, 1):  # never fewer than the session has
        assert spark.conf.get(key) == before
    with pytest.raises(ValueError):
        with dealt(spark, 99):
            raise ValueError
    assert spark.conf.get(key) == before


def test_stored_trades_are_written_where_they_are_labelled(spark, tiny, written, monkeypatch):
    """No shuffle of whole rows after the one to their markets, in more partitions for large files."""
    monkeypatch.setattr(registry.V, "DEALT_BYTES", 5_000)
    parts = registry.V.dealt_parts(spark, tiny, "lineitem")
    got = registry.QUERIES["stored_trades"](spark, tiny)
    (plan,) = written
    assert "rangepartitioning(date" not in plan and "SortMergeJoin [nonusdc_asset_id" in plan
    for column in ("id", "nonusdc_asset_id"):
        assert any(f"hashpartitioning({column}#" in x and f", {parts})" in x for x in plan.splitlines())
    want = registry.QUERIES["label_trades"](spark, tiny)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_each_task_has_whole_markets(spark, tmp_path):
    fills = spark.createDataFrame(
        [fill(str(i), f"T{i % 5}", ts=i) for i in range(100)], schemas.FILLS).repartition(7)
    known = markets_of(spark, **{f"m{i}": f"T{i}" for i in range(4)})
    writers.write_trades(L.label_by_token(fills, known), str(tmp_path / "t"), ranged=False)
    files = (spark.read.parquet(str(tmp_path / "t")).selectExpr("market_id", "_metadata.file_name f")
             .distinct().groupBy("market_id").count())
    assert {r[0]: r[1] for r in files.collect()} == dict.fromkeys(["m0", "m1", "m2", "m3", None], 1)


def test_repair_moves_unmatched_trades_only(spark, tiny, written):
    got = registry.QUERIES["repair_stored"](spark, tiny)
    want = registry.QUERIES["label_trades"](spark, tiny)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    _, plan = written
    assert "Exchange rangepartitioning" not in plan and "rebalance" not in plan.lower()
    settled = plan[plan.index("Union"):].split(":- ")[1]  # the first branch of the union
    assert "coalesce(is_matched" in settled
    assert not any(x in settled for x in ("Exchange", "Join"))


def test_repair_replaces_settled_copies_of_its_ids(spark, tmp_path, written):
    """An id stored twice, with its market and without: the repaired trade replaces both."""
    path = str(tmp_path / "t")
    early, late = markets_of(spark, m1="T1"), markets_of(spark, m1="T1", m2="T2")
    rows = [fill("a", "T1"), fill("b", "T2"), fill("c", "T3"), fill(None, "T2"),
            fill("d", "T3", ts=200 * 86_400)]
    fills = spark.createDataFrame(rows, schemas.FILLS)
    writers.write_trades(L.label_trades(fills, early), path)
    writers.write_trades(L.label_trades(fills.filter("id = 'b'"), late), path)
    assert writers.rewrite_repaired(spark, path, fills, late) == 1
    got = [(r["id"], r["market_id"]) for r in read_trades(spark, path).collect()]
    assert sorted(got, key=str) == sorted(
        [("a", "m1"), ("b", "m2"), ("c", None), ("d", None), (None, None)], key=str)
    assert written[-1].count("LeftAnti") == 2
    assert writers.rewrite_repaired(spark, path, fills, late) == 0


def test_staged_buckets_do_not_move(spark):
    rows = [fill(str(i), f"T{i % 5}") for i in range(50)] + [fill(None, "T1")]
    fills = spark.createDataFrame(rows, schemas.FILLS)
    kept = stage_buckets(fills.repartition("id"), "fills", "id", "zstd")
    assert kept.exceptAll(fills).isEmpty() and fills.exceptAll(kept).isEmpty()
    some = spark.createDataFrame([("3",), ("7",), ("x",), (None,)], "id string").hint("merge")
    found = kept.join(some, "id", "left_semi")
    assert physical(found).count("Exchange hashpartitioning") == 1
    assert sorted(r["id"] for r in found.collect()) == ["3", "7"]


def test_stored_trades_keep_filters_no_larger_than_their_values(spark, tmp_path):
    """Three filters of a megabyte each in every small file would outweigh the trades."""
    fills = spark.createDataFrame([fill(str(i), "T1") for i in range(20)], schemas.FILLS)
    trades = L.label_trades(fills, markets_of(spark, m1="T1")).coalesce(1)
    writers.write_trades(trades, str(tmp_path / "t"), ranged=False)
    assert sum(f.stat().st_size for f in (tmp_path / "t").rglob("*.parquet")) < 100_000
