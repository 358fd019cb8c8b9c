"""Running results by chunks against the same results by one sorted pass."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import bars as B, chunks as C, reports as R, signals as G
from tidemark.plans import testviews as V
from tidemark.session import stage


def made(seed, n=400):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), t, rng.choice([None, rng.randint(-5, 5)]), i)
            for i, t in enumerate(sorted(rng.choices(range(1000), k=n)))]
    rows += [("one", 5, 1, -1)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, timestamp long, v int, id long").repartition(5)


def brute(rows):
    out = {}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[3]))
        for i, r in enumerate(own):
            upto = [x[2] for x in own[:i + 1] if x[2] is not None]
            before = [x[2] for x in own[:i] if x[2] is not None]
            out[r[3]] = (i + 1, sum(upto) if upto else None, max(upto, default=None),
                         upto[-1] if upto else None, before[-1] if before else None,
                         own[i + 1][3] if i + 1 < len(own) else None)
    return out


def wanted():
    v = F.col("v")
    return {"n": C.count(), "s": C.total(v), "m": C.highest(v), "l": C.newest(v), "b": C.newest(v, before=True),
            "f": C.following(F.struct("id"))}


@pytest.mark.parametrize("seconds", [None, 1, 7, 100, 5000])
def test_scan(spark, seconds):
    rows = made(seconds or 0)
    got = C.scan(frame(spark, rows), ["k"], wanted(), ["timestamp", "id"], C.chunk_of("timestamp", seconds))
    found = {r["id"]: (r["n"], r["s"], r["m"], r["l"], r["b"], r["f"] and r["f"]["id"]) for r in got.collect()}
    assert found == brute(rows)


def test_scan_of_nothing(spark):
    empty = frame(spark, made(1)).limit(0)
    for chunk in (None, C.chunk_of("timestamp", 9)):
        assert C.scan(empty, ["k"], wanted(), ["timestamp", "id"], chunk).count() == 0


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_rows_are_ordered_inside_chunks_only(spark, tiny):
    """The one window by market alone runs over summaries of chunks."""
    bars = stage(B.ohlcv(V.ticks(spark, tiny)), "bars")
    for made in (G.crossover(bars, 5, 20, seconds=86_400), R.drawdown_curve(bars, "close", seconds=86_400)):
        plan = made._jdf.queryExecution().executedPlan().toString()
        windows = [line for line in plan.split("\n") if re.search(r"\bWindow \[", line)]
        alone = [line for line in windows if not re.search(r"\], \[market_id#\d+.*_chunk#\d+L?\], \[", line)]
        assert windows and all("_chunk" in line and "timestamp" not in line.split("], [")[-1] for line in alone)


def test_chunked_forms_agree(spark, tiny):
    bars = stage(B.ohlcv(V.ticks(spark, tiny)), "bars")
    day, week = 86_400, 7 * 86_400
    assert same(G.sma(bars, 3, 50), G.sma(bars, 3, 50, seconds=week))
    grid = [{"fast": 3, "slow": 9, "stop_loss": 0.1}, {"fast": 5, "slow": 30, "stop_loss": 0.02}]
    one, many = G.crossings(bars, grid), G.crossings(bars, grid, seconds=day)
    assert same(one, many)
    keys = ["market_id", "param_id"]
    trades = G.episodes(one, stop_loss=F.col("stop_loss"), keys=keys)
    assert trades.count() > 20
    assert same(trades, G.episodes(stage(many, "signals"), stop_loss=F.col("stop_loss"), keys=keys, seconds=day))
    assert same(R.drawdown(bars, "close"), R.drawdown(bars, "close", seconds=day))
    money = G.equity(trades, keys=keys)
    assert same(R.streaks(money, keys), R.streaks(money, keys, size=2))


def test_a_grid_given_as_a_table(spark, tiny):
    bars = stage(B.ohlcv(V.ticks(spark, tiny)), "bars")
    sets = [{"fast": 2 + i % 5, "slow": 10 + i, "stop_loss": 0.01 * (1 + i % 3)} for i in range(60)]
    table = spark.createDataFrame([tuple(s.values()) for s in sets], "fast int, slow int, stop_loss double")
    assert same(G.param_grid(bars, sets), G.param_grid(bars, table.orderBy("slow")))
