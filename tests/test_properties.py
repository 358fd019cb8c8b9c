"""Results that must not depend on partitioning, order, or how the input arrived."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bars as B, fills as FL, labelling as L, markets as M, traders as X
from tidemark.plans import registry, testviews as V


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def base(spark, tiny):
    return registry.fills(spark, tiny).cache(), registry.markets(spark, tiny).cache()


def test_partitioning_does_not_matter(spark, tiny, base):
    fills, markets = base
    ticks = V.ticks(spark, tiny)
    assert same(B.ohlcv(ticks), B.ohlcv(ticks.repartition(7).sortWithinPartitions(
        F.col("id").desc())))
    one = X.market_metrics(X.side_metrics(L.label_trades(fills.coalesce(1), markets), markets))
    many = X.market_metrics(X.side_metrics(L.label_trades(fills.repartition(9), markets), markets))
    assert same(one, many)


def test_labels_keep_every_fill(base):
    fills, markets = base
    trades = L.label_trades(fills, markets)
    assert trades.count() == fills.count()
    assert trades.filter("maker_direction = taker_direction").isEmpty()


@pytest.mark.parametrize("split", [0, 880_000_000, 950_000_000, 2_000_000_000])
def test_incremental_equals_rebuild(base, split):
    fills, markets = base
    full = L.label_trades(fills, markets)
    stored = L.label_trades(fills.filter(F.col("timestamp") < split), markets)
    assert same(full, stored.unionByName(L.incremental_trades(fills, stored, markets)))


def test_incremental_of_scattered_rows_with_since(base):
    fills, markets = base
    full = L.label_trades(fills, markets)
    stored = L.label_trades(fills.filter("crc32(id) % 3 > 0 OR timestamp < 900000000"), markets)
    more = L.incremental_trades(fills, stored, markets, since=900_000_000)
    assert same(full, stored.unionByName(more))


def test_repair_equals_rebuild(spark, tiny, base):
    fills, markets = base
    early = L.label_trades(fills, M.combine_markets(V.main_markets(spark, tiny)))
    assert early.filter("NOT is_matched").count() > 60
    assert same(L.repair_unmatched(early, fills, markets), L.label_trades(fills, markets))


def test_copies_of_a_hot_id_collapse(spark, base):
    fills, _ = base
    hot = fills.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(50_000)))).drop("n")
    assert same(FL.dedup_fills(fills.unionByName(hot)), FL.dedup_fills(fills))
