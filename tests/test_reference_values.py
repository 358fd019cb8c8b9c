"""Reference values of FIXTURES.md at both scales."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import (
    bars as B, fills as FL, labelling as L, markets as M, matching as D, pricing as P,
    reports as R, signals as G, traders as X)
from tidemark.plans import registry, testviews as V

VALUES = {
    "tiny": dict(
        landed=6918, fills=(5999, 114_685_320_000), markets=(198, 2), missing=4,
        trades=(5999, 5939, 5975, 36), usd=76_710.73, tokens=151_987.17, price=3020.98,
        last=(398, 6, 6), sides=(3047, 59.33, 225_874.0, 962), by_market=(1887, 37),
        traders=(10, 918, 357, 620.02, -378.6, 184), top=("0xm00000006", 190, 84, 36, 72.5292, -120.03),
        depth=(1473, 126), summary=(3.3612, 3), bars=(977, 49.13633, 49.06178, 50_050.19),
        periods=(5, 20), crosses=(92, 92), episodes=(68, 68, 4.607663), fall=745.087318),
    "small": dict(
        landed=68_598, fills=(60_000, 1_144_026_330_000), markets=(1980, 20), missing=40,
        trades=(60_000, 59_383, 59_681, 298), usd=761_289.32, tokens=1_520_266.9, price=30_000.91,
        last=(3962, 38, 44), sides=(55_006, 1703.36, 4_026_050.2, 26_386), by_market=(51_192, 4084),
        traders=(100, 23_604, 7295, 9535.29, -4149.07, 462),
        top=("0xm00000065", 532, 246, 96, 127.8638, 53.53),
        depth=(14_743, 1137), summary=(3.9873, 4), bars=(8016, 397.14262, 400.73468, 496_306.57),
        periods=(50, 200), crosses=(202, 205), episodes=(156, 156, 20.754342), fall=6718.76048),
}


@pytest.mark.parametrize("scale", ["tiny", "small"])
def test_values(spark, request, scale):
    d, want = request.getfixturevalue(scale), VALUES[scale]
    landed = V.landed_fills(spark, d)
    assert landed.count() == want["landed"]
    fills = FL.dedup_fills(landed)
    assert tuple(fills.agg(F.count("*"), F.sum("makerAmountFilled")).head()) == want["fills"]
    markets = registry.markets(spark, d)
    assert (markets.count(), markets.filter("question LIKE '%(late)'").count()) == want["markets"]
    assert FL.missing_tokens(fills, M.markets_long(markets)).count() == want["missing"]
    trades = L.label_trades(fills, markets)
    r = trades.agg(F.count("*"), F.count("market_id"), F.count("nonusdc_side"),
                   F.count_if(F.col("nonusdc_side") == "USDC"), F.sum("usd_amount"),
                   F.sum("token_amount"), F.sum("price")).head()
    assert tuple(r[:4]) == want["trades"]
    assert (round(r[4], 2), round(r[5], 2), round(r[6], 4)) == (
        want["usd"], want["tokens"], want["price"])
    last = F.col("last_price")
    assert tuple(P.last_price(trades).agg(F.count("*"), F.count_if(last == 1),
                                          F.count_if(last == 0)).head()) == want["last"]
    sides = X.side_metrics(trades, markets)
    r = sides.agg(F.count("*"), F.sum("total_pnl_usd"), F.sum("pct_change"),
                  F.count_if(F.col("pct_change").isNull())).head()
    assert (r[0], round(r[1], 2), round(r[2], 1), r[3]) == want["sides"]
    by_market = X.market_metrics(sides)
    assert tuple(by_market.agg(F.count("*"), F.count_if(F.col("total_pnl_usd") == 0))
                 .head()) == want["by_market"]
    traders = X.trader_metrics(by_market)
    r = traders.agg(F.count("*"), F.sum("wins"), F.sum("big_wins_count"), F.sum("median_win_pct"),
                    F.sum("median_loss_pct"), F.min("markets_traded")).head()
    assert (*r[:3], round(r[3], 2), round(r[4], 2), r[5]) == want["traders"]
    top = X.rank_traders(traders.drop("wins_"), min_markets=0).head()
    wins = traders.filter(F.col("maker") == top["wallet"]).head()["wins"]
    assert (top["wallet"], top["markets_traded"], wins, top["big_wins_count"],
            round(top["median_win_pct"], 4), top["total_pnl_usd"]) == want["top"]
    depth = D.match_depth(trades)
    assert tuple(depth.agg(F.count("*"), F.count_if(F.col("num_makers_matched") == 1))
                 .head()) == want["depth"]
    r = D.match_depth_summary(depth).head()
    assert (round(r["avg_makers"], 4), r["median_makers"]) == want["summary"]
    bars = B.ohlcv(V.ticks(spark, d))
    r = bars.agg(F.count("*"), F.sum("open"), F.sum("close"), F.sum("volume")).head()
    assert (r[0], round(r[1], 5), round(r[2], 5), round(r[3], 2)) == want["bars"]
    signals = G.crossover(bars, *want["periods"])
    assert tuple(signals.agg(F.count_if(F.col("cross") == 1), F.count_if(F.col("cross") == -1))
                 .head()) == want["crosses"]
    r = G.episodes(signals).agg(F.count("*"), F.count("exit_ts"), F.sum(F.ln("factor"))).head()
    assert (r[0], r[1], round(r[2], 6)) == want["episodes"]
    fall = R.drawdown_curve(bars, "close").agg(F.sum(F.col("drawdown") / 100)).head()[0]
    assert round(fall, 6) == want["fall"]
