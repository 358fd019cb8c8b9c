"""Bars, moving averages and the relational rule against a plain loop."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bars as B
from tidemark.operators import reports as R
from tidemark.operators import signals as G
from tidemark.operators import upsert as U


def ticks(spark, rows):
    df = spark.createDataFrame(
        rows, "market_id string, s long, id long, nonusdc_side string, price double, "
              "usd_amount double")
    return df.withColumn("timestamp", F.timestamp_seconds("s"))


def bar_frame(spark, closes, opens=None, market="m"):
    opens = opens or closes
    rows = [(market, i * 600, o, max(o, c), min(o, c), c, 1.0)
            for i, (o, c) in enumerate(zip(opens, closes))]
    df = spark.createDataFrame(rows, "market_id string, s long, open double, high double, "
                                     "low double, close double, volume double")
    return df.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")


def test_bar_edges_ties_and_mirroring(spark):
    base = 36_000  # 10:00:00
    rows = [("m", base - 1, 1, "token1", 0.1, 1.0), ("m", base, 3, "token2", 0.4, 1.0),
            ("m", base, 2, "token1", 0.3, 1.0), ("m", base + 599, 4, "token1", 0.5, 1.0),
            ("m", base + 100, 5, "token1", None, 2.0), ("m", base + 700, 6, "token1", None, 2.0)]
    got = [(int(r["s"]), r["open"], r["high"], r["low"], r["close"], r["volume"]) for r in
           B.ohlcv(ticks(spark, rows)).withColumn("s", F.unix_seconds("timestamp"))
           .orderBy("s").collect()]
    assert got == [(base - 600, 0.1, 0.1, 0.1, 0.1, 1.0), (base, 0.3, 0.6, 0.3, 0.5, 5.0)]


def test_bar_direction_and_filters(spark):
    df = bar_frame(spark, [1.0, 2.0, 3.0], [1.0, 3.0, float("nan")])
    assert [r["is_up"] for r in B.bar_direction(df).orderBy("timestamp").collect()] == [
        True, False, None]
    at = F.timestamp_seconds(F.lit(600))
    assert B.bars_since(df, at).count() == 2
    assert B.bars_since(df, at, [at]).count() == 1


def test_sma_needs_n_bars(spark):
    got = [r["sma_3"] for r in G.sma(bar_frame(spark, [1.0, 2.0, 4.0, 6.0]), 3)
           .orderBy("timestamp").collect()]
    assert got[:2] == [None, None] and got[2:] == [pytest.approx(7 / 3), 4.0]


def test_cross_skips_equal_averages(spark):
    # fast over 1, slow over 2: the averages are equal where the close repeats
    df = bar_frame(spark, [2.0, 1.0, 1.0, 2.0, 2.0, 1.0])
    got = [r["cross"] for r in G.crossover(df, 1, 2).orderBy("timestamp").collect()]
    assert got == [0, 0, 0, 1, 0, -1]


def loop(bars, fast, slow, stop, risk=0.95, cash=10_000.0):
    """The rule bar by bar: orders decided at a close fill at the next open."""
    units = [round(b["close"] * 1e6) for b in bars]
    done, held, order, last, before = [], None, None, 0, cash
    for i, bar in enumerate(bars):
        if order == "sell":
            held.update(exit=i, exit_price=bar["open"])
            cash += held["size"] * (bar["open"] - held["entry_price"])
            done.append(held)
            held = None
        elif order is not None and order["size"] * bar["open"] <= cash:
            held = dict(order, entry=i, entry_price=bar["open"])
        order, cross = None, 0
        if i + 1 >= slow:
            diff = (sum(units[i + 1 - fast:i + 1]) * slow
                    - sum(units[i + 1 - slow:i + 1]) * fast)
            cross = 1 if last < 0 < diff else -1 if diff < 0 < last else 0
            last = diff if diff else last
        if held:
            if bar["close"] <= held["entry_price"] * (1 - stop) or cross < 0:
                order = "sell"
        elif cross > 0:
            order = {"size": risk * cash / bar["close"], "cash": cash}
    return done, held, cash


@pytest.mark.parametrize("seed", range(4))
def test_rule_equals_loop(spark, seed):
    rng = random.Random(seed)
    frames, want = [], {}
    for name in ("a", "b"):
        price, closes, opens = 0.5, [], []
        for _ in range(400):
            price = min(0.99, max(0.01, price + rng.gauss(0, 0.02)))
            opens.append(round(min(0.99, max(0.01, price + rng.gauss(0, 0.01))), 4))
            closes.append(round(price, 2))
        frames.append(bar_frame(spark, closes, opens, name))
        rows = [r.asDict() for r in frames[-1].orderBy("timestamp").collect()]
        want[name] = loop(rows, 5, 20, 0.02)
    bars = frames[0].unionByName(frames[1])
    trades = G.equity(G.episodes(G.crossover(bars, 5, 20)))
    got = defaultdict(list)
    for r in trades.orderBy("market_id", "episode_id").collect():
        got[r["market_id"]].append(r)
    for name, (done, held, cash) in want.items():
        closed = [r for r in got[name] if r["exit_ts"] is not None]
        assert [(r["entry_bar"] - 1, r["exit_bar"] - 1) for r in closed] == [
            (t["entry"], t["exit"]) for t in done]
        assert len(got[name]) - len(closed) == (held is not None)
        assert got[name][-1]["cash_after"] == pytest.approx(cash)
        assert [r["size"] for r in closed] == [pytest.approx(t["size"]) for t in done]
    curve = G.equity_curve(bars, trades)
    ends = curve.groupBy("market_id").agg(F.max_by("equity", "timestamp").alias("e"),
                                          F.max_by("close", "timestamp").alias("c"))
    for r in ends.collect():
        done, held, cash = want[r["market_id"]]
        mark = held["size"] * (r["c"] - held["entry_price"]) if held else 0.0
        assert r["e"] == pytest.approx(cash + mark)


def test_stop_on_the_bar_of_a_down_cross_counts_as_stop(spark):
    df = bar_frame(spark, [3.0, 2.0, 1.0, 4.0, 1.0, 1.0], [3.0, 2.0, 1.0, 4.0, 3.5, 1.0])
    r = G.episodes(G.crossover(df, 1, 2)).head()
    assert r["exit_reason"] == "stop" and r["exit_bar"] == 6
    assert r["factor"] == pytest.approx(1 + 0.95 / 4.0 * (1.0 - 3.5))


def test_commission_and_unfilled_order(spark):
    jump = bar_frame(spark, [3.0, 2.0, 1.0, 4.0, 4.0, 1.0], [3.0, 2.0, 1.0, 4.0, 5.0, 1.0])
    assert G.episodes(G.crossover(jump, 1, 2)).count() == 0  # next open is beyond the cash
    df = bar_frame(spark, [3.0, 2.0, 1.0, 4.0, 4.0, 1.0, 1.0])
    r = G.episodes(G.crossover(df, 1, 2), commission=0.01).head()
    assert r["factor"] == pytest.approx(1 + 0.95 / 4 * (1 - 4) - 0.01 * 0.95 / 4 * (1 + 4))


def test_user_rule(spark):
    df = bar_frame(spark, [1.0, 1.0, 2.0, 2.0, 1.9, 1.9])
    got = G.episodes(df, enter=F.col("timestamp") == F.timestamp_seconds(F.lit(600)),
                     leave=F.col("close") == 1.9, stop_loss=0.5, risk=0.4).collect()
    assert [(r["entry_price"], r["exit_price"]) for r in got] == [(2.0, 1.9)]


def test_ruined_run_stays_at_zero(spark):
    rows = [("m", 1, 1.0, 0.5, 1.0), ("m", 2, 1.0, 0.0, 1.0), ("m", 3, 1.0, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "market_id string, episode_id int, signal_close double, "
                                     "factor double, risk double")
    df = df.withColumn("exit_ts", F.timestamp_seconds("episode_id"))
    got = [(r["cash_before"], r["cash_after"]) for r in
           G.equity(df, 100.0).orderBy("episode_id").collect()]
    assert got == [(100.0, pytest.approx(50.0)), (pytest.approx(50.0), 0.0), (0.0, 0.0)]


def curve(spark, values, step=86_400):
    rows = [("m", i * step, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "market_id string, s long, equity double")
    return df.withColumn("timestamp", F.timestamp_seconds("s")).drop("s")


def test_drawdown_and_returns(spark):
    c = curve(spark, [100.0, 120.0, 90.0, 96.0, 130.0, 117.0])
    r = R.drawdown(c).head()
    assert (r["length"], r["max_length"], r["moneydown"], r["max_moneydown"]) == (1, 2, 13.0, 30.0)
    assert r["drawdown"] == pytest.approx(10.0) and r["max_drawdown"] == pytest.approx(25.0)
    returns = [x["period_return"] for x in
               R.time_return(c, cash=100.0).orderBy("period").collect()]
    assert returns == [pytest.approx(v) for v in (0.0, 0.2, -0.25, 96 / 90 - 1, 130 / 96 - 1, -0.1)]
    stats = R.period_stats(R.time_return(c, cash=100.0)).head()
    assert (stats["positive"], stats["negative"], stats["nochange"]) == (3, 2, 1)
    sd = math.sqrt(sum((x - sum(returns) / 6) ** 2 for x in returns) / 5)
    ratio = R.sharpe(R.time_return(c, cash=100.0)).head()["sharpe_ratio"]
    assert ratio == pytest.approx(sum(returns) / 6 / sd)


def test_steady_growth_has_no_variability(spark):
    c = curve(spark, [100 * math.exp(0.01 * i) for i in range(1, 11)])
    r = R.vwr(R.time_return(c, cash=100.0), cash=100.0).head()
    assert r["vwr"] == pytest.approx((math.exp(0.01 * 252) - 1) * 100)


def test_streaks(spark):
    pnl = [1.0, 2.0, -1.0, 0.0, 3.0, 4.0, -1.0, -2.0, None]
    df = spark.createDataFrame([("m", i, p) for i, p in enumerate(pnl)],
                               "market_id string, episode_id int, pnl double")
    r = R.streaks(df).head()
    assert (r["won_current"], r["won_longest"], r["lost_current"], r["lost_longest"]) == (0, 3, 2, 2)


def test_flatten_report(spark):
    df = spark.createDataFrame([("m", 1)], "market_id string, a int").select(
        "market_id", F.struct("a", F.struct(F.lit(2.5).alias("x y")).alias("in")).alias("top"))
    assert {(r["label"], r["value"]) for r in R.flatten_report(df).collect()} == {
        ("top - a", "1"), ("top - in - x y", "2.5")}


def test_upsert_and_update_type(spark):
    schema = "market_id string, timestamp long, open double, volume double"
    old = spark.createDataFrame([("m", 1, 1.0, 1.0), ("m", 2, 2.0, 2.0)], schema)
    new = spark.createDataFrame(
        [("m", 2, None, 9.0), ("m", 3, 3.0, 3.0), ("m", 0, 0.0, 0.0), ("n", 1, 1.0, 1.0)], schema)
    got = {(r["market_id"], r["timestamp"]): (r["open"], r["volume"])
           for r in U.upsert_bars(old, new).collect()}
    assert got[("m", 2)] == (2.0, 9.0) and got[("m", 1)] == (1.0, 1.0) and len(got) == 5
    kinds = {(r["market_id"], r["timestamp"]): r["update_type"]
             for r in U.bar_update_type(old, new).collect()}
    assert kinds == {("m", 2): "UPDATE_LAST", ("m", 3): "APPEND", ("m", 0): "FILL_OR_PREPEND",
                     ("n", 1): "APPEND"}


def test_averages_keep_small_prices(spark):
    """Closes below a millionth are averaged as they are."""
    bars = spark.createDataFrame(
        [("m", i, 4e-7 * (1 + i % 2)) for i in range(6)], "market_id string, timestamp long, close double")
    got = [r["sma_2"] for r in G.sma(bars, 2).orderBy("timestamp").collect()]
    assert got[0] is None and all(abs(x - 6e-7) < 1e-12 for x in got[1:])


def walked(bars, stop, risk=0.95):
    """Trades of one series by a plain walk: (signal bar, exit bar, reason). Rows: open, close,
    enters, leaves; bars count from 1."""
    out, held = [], None
    for i, (_, close, enters, leaves) in enumerate(bars):
        after = bars[i + 1][0] if i + 1 < len(bars) else None
        if held:
            stopped = close <= held[1] * (1 - stop)
            if stopped or leaves:
                out.append((held[0], i + 2 if after is not None else None,
                            ("stop" if stopped else "cross") if after is not None else None))
                held = None
        elif enters and after is not None and risk * after <= close:
            held = (i + 1, after)
    return out + ([(held[0], None, None)] if held else [])


@pytest.mark.parametrize("seconds", [None, 4])
def test_entries_during_an_open_trade_are_ignored(spark, seconds):
    rng = random.Random(9)
    series = {}
    for m in range(40):
        p_in, p_out = rng.choice([(0.1, 0.1), (0.6, 0.05), (0.9, 0.0), (0.5, 0.5)])
        price, rows = 10.0, []
        for _ in range(rng.randint(1, 40)):
            price *= 1 + rng.uniform(-0.06, 0.06)
            rows.append((price, price * (1 + rng.uniform(-0.02, 0.02)), rng.random() < p_in, rng.random() < p_out))
        series[f"m{m}"] = rows
    frame = spark.createDataFrame([(m, i, *r) for m, rows in series.items() for i, r in enumerate(rows)],
                                  "market_id string, timestamp long, open double, close double, "
                                  "enters boolean, leaves boolean").repartition(3)
    found = G.episodes(frame, F.col("enters"), F.col("leaves"), stop_loss=0.05, seconds=seconds).collect()
    got = {m: [] for m in series}
    for r in sorted(found, key=lambda r: r["episode_id"]):
        got[r["market_id"]].append((r["entry_bar"] - 1, r["exit_bar"], r["exit_reason"]))
        entered = [i for i, row in enumerate(series[r["market_id"]], 1) if row[2]]
        assert entered[r["episode_id"] - 1] == r["entry_bar"] - 1
    assert got == {m: walked(rows, 0.05) for m, rows in series.items()}
    assert sum(len(t) for t in got.values()) > 60


def test_null_flags_neither_enter_nor_leave(spark):
    rows = [("m", i, 10.0, 10.0, c) for i, c in enumerate([0, 1, None, 1, 0, -1, 0])]
    signals = spark.createDataFrame(
        rows, "market_id string, timestamp long, open double, close double, cross int")
    got = G.episodes(signals).collect()
    assert [(r["episode_id"], r["entry_bar"], r["exit_bar"], r["exit_reason"]) for r in got] == [(1, 3, 7, "cross")]


def test_idle_sets_and_runs_have_rows(spark):
    bars = spark.createDataFrame(
        [("m", i, 10.0 + i % 3, 10.0 + i % 3) for i in range(9)],
        "market_id string, timestamp long, open double, close double")
    grid = G.param_grid(bars, [{"fast": 3, "slow": 99, "stop_loss": 0.1}]).collect()
    assert [(r["trades"], r["won"], r["final_cash"]) for r in grid] == [(0, 0, 10_000.0)]
    runs = spark.createDataFrame([("x",), ("y",)], "market_id string")
    none = G.equity(G.episodes(G.crossover(bars, 3, 99)))
    report = R.trade_analysis(none, runs=runs).collect()
    assert [(r["total"], r["won_longest"], r["pnl_net_total"], r["pnl_net_average"])
            for r in report] == [(0, 0, 0.0, None)] * 2
    assert {r["trades"] for r in R.sqn(none, runs=runs).collect()} == {0}
    assert {r["lost_longest"] for r in R.streaks(none, runs=runs).collect()} == {0}
