"""Moving averages, crossings, and the trades a rule would have made.

Running results go over bars, by market and parameter set: one sorted window per series, whose
bars the calendar bounds (52,560 ten-minute bars a year), or, with ``seconds``, chunks of that much
time (``operators/chunks.py``) for series that nothing bounds. Parameter sets multiply the rows
of a bar from one constant; what their averages need are values of one running sum, so their number
changes no plan.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.chunks import chunk_of, count, following, newest, same, scan, total
from tidemark.session import stage

KEYS = ("market_id",)
_FINE = 1e12  # units of a close in running sums
_UNITS = "decimal(28,0)"


def _by_time(keys: Sequence[str]):
    return Window.partitionBy(*keys).orderBy("timestamp")


def _running_sums(bars: DataFrame, periods: Sequence[int], keys: Sequence[str],
                  seconds: int | None) -> DataFrame:
    """Bars with their number, the running sum of closes in units of 10**-12, and by period what
    that sum was so many bars before.

    The sums are exact, since the units are whole and added as decimals; they are finer than what
    a price that is a ratio of two amounts can lose by them. In chunks, every bar sends its sum to
    the bars that lie a period ahead, so rows move by market and bar number.
    """
    units = F.rint(F.col("close") * F.lit(_FINE)).cast("decimal(20,0)")
    periods = sorted(set(periods))
    running = scan(bars, keys, {"_n": count(), "_run": total(units)}, chunk=chunk_of("timestamp", seconds))
    running = running.withColumn("_run", F.col("_run").cast(_UNITS))
    if seconds is None:
        w = _by_time(keys)
        pairs = [c for p in periods for c in (F.lit(p), F.lag("_run", p).over(w))]
        return running.withColumn("_earlier", F.create_map(*pairs))
    running = stage(running, "running-sums")
    of = [f"_of_{i}" for i in range(len(keys) + 1)]
    ahead = running.select(
        *[F.col(k).alias(c) for k, c in zip(keys, of)], "_n", F.col("_run").alias("_sum"),
        F.explode(F.array(*[F.lit(p) for p in periods])).alias("_period"))
    earlier = ahead.groupBy(*of[:-1], (F.col("_n") + F.col("_period")).alias(of[-1])).agg(
        F.map_from_entries(F.collect_list(F.struct("_period", "_sum"))).alias("_earlier"))
    return running.join(earlier, same([*keys, "_n"], of), "left").drop(*of)


def _last_sum(n: int | Column) -> Column:
    """The sum of the last n closes of a bar of ``_running_sums``, null until n bars exist."""
    n = F.lit(n)
    earlier = F.coalesce(F.try_element_at("_earlier", n), F.lit(0).cast(_UNITS))
    return F.when(F.col("_n") >= n, F.col("_run") - earlier).cast(_UNITS)


def _average(units: Column, n: int | Column) -> Column:
    return units.cast("double") / (F.lit(n) * F.lit(_FINE))


def sma(bars: DataFrame, *periods: int, keys: Sequence[str] = KEYS,
        seconds: int | None = None) -> DataFrame:
    """Simple moving averages of the close as columns ``sma_<n>``."""
    sums = _running_sums(bars, periods, keys, seconds)
    return sums.select(*bars.columns, *[_average(_last_sum(p), p).alias(f"sma_{p}") for p in periods])


_TYPES = {bool: "boolean", int: "int", float: "double", str: "string"}


def parameter_sets(grid: Sequence[dict] | DataFrame) -> tuple[list[dict], Column]:
    """The sets of a grid, given as dictionaries or as a table with one row each, and the same as
    one constant array with their numbers (``param_id``)."""
    if isinstance(grid, DataFrame):
        grid = [row.asDict() for row in grid.collect()]
    sets = [{"param_id": i, **params} for i, params in enumerate(grid)]
    fields = ", ".join(f"`{name}`: {_TYPES[type(value)]}" for name, value in sets[0].items())
    return sets, F.from_json(F.lit(json.dumps(sets)), f"array<struct<{fields}>>")


def crossings(bars: DataFrame, grid: Sequence[dict] | DataFrame, keys: Sequence[str] = KEYS,
              seconds: int | None = None) -> DataFrame:
    """Bars times parameter sets, with both averages and ``cross`` (+1 up, -1 down, 0 none).

    ``grid`` holds {fast, slow, ...}, see :func:`parameter_sets`; other entries become columns.
    """
    sets, constant = parameter_sets(grid)
    sums = _running_sums(bars, [p for s in sets for p in (s["fast"], s["slow"])], keys, seconds)
    found = F.transform(constant, lambda s: F.struct(
        *[s[name].alias(name) for name in sets[0]],
        _last_sum(s["fast"]).alias("_fast"), _last_sum(s["slow"]).alias("_slow")))
    runs = sums.select(*bars.columns, F.inline(found))
    # compares the averages without dividing; null until both exist
    side = F.signum(F.col("_fast") * F.col("slow") - F.col("_slow") * F.col("fast"))
    before = newest(F.nullif(F.col("_side"), F.lit(0.0)), before=True)
    cross = F.when((F.col("_before") < 0) & (F.col("_side") > 0), 1).when(
        (F.col("_before") > 0) & (F.col("_side") < 0), -1).otherwise(0)
    return (
        scan(runs.withColumn("_side", side), [*keys, "param_id"], {"_before": before},
             chunk=chunk_of("timestamp", seconds))
        .withColumns({
            "fast_ma": _average(F.col("_fast"), F.col("fast")),
            "slow_ma": _average(F.col("_slow"), F.col("slow")),
            "cross": cross})
        .drop("_fast", "_slow", "_side", "_before")
    )


def crossover(bars: DataFrame, fast: int = 50, slow: int = 200, keys: Sequence[str] = KEYS,
              seconds: int | None = None) -> DataFrame:
    runs = crossings(bars, [{"fast": fast, "slow": slow}], keys, seconds)
    return runs.drop("param_id", "fast", "slow")


def _walk(spans: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``e`` and ``x`` (null: open) of the trades among ``spans``: an entry counts only while no
    trade is open.

    Spans run from one entry to the next; those between two exit signals are folded in order,
    since a trade never outlives its stretch. A span knows its own trade's end, its first exit signal
    and its lows, the bars that close below all before them: the first of these at or below the
    stop of a trade that is still open is where that one ends.
    """
    stretches = spans.groupBy(*keys, "_segment").agg(F.array_sort(F.collect_list(
        F.struct("episode_id", "fits", "e", "x", "leave", "lows"))).alias("spans"))
    types = {f.name: f.dataType.simpleString() for f in stretches.schema["spans"].dataType.elementType.fields}
    pair = f"struct<e:{types['e']},x:{types['x']}>"
    whole = f"struct<held:{pair},done:array<{pair}>>"
    start = F.struct(F.lit(None).cast(pair).alias("held"), F.array().cast(f"array<{pair}>").alias("done"))

    def step(state: Column, span: Column) -> Column:
        held, leave = state["held"], span["leave"]
        limit = held["e"]["entry_price"] * (1 - held["e"]["stop"])
        stop = F.get(F.filter(span["lows"], lambda low: low["close"] <= limit), F.lit(0))["x"]
        stops = stop.isNotNull() & (leave.isNull() | (stop["bar"] <= leave["bar"]))
        carried = F.struct(held["e"].alias("e"), F.when(stops, stop).otherwise(leave).alias("x"))
        own = F.struct(span["e"].alias("e"), span["x"].alias("x"))
        trade = F.when(held.isNotNull(), carried).when(span["fits"], own)
        over = trade["x"].isNotNull()
        return F.struct(
            F.when(trade.isNotNull() & ~over, trade).alias("held"),
            F.when(over, F.concat(state["done"], F.array(trade))).otherwise(state["done"]).alias("done")
        ).cast(whole)

    walked = stretches.select(*keys, F.aggregate("spans", start, step).alias("w"))
    last = F.when(F.col("w.held").isNull(), F.array().cast(f"array<{pair}>")).otherwise(F.array("w.held"))
    return walked.select(*keys, F.inline(F.concat("w.done", last)))


def episodes(signals: DataFrame, enter: Column | None = None, leave: Column | None = None,
             stop_loss: float | Column = 0.02, risk: float = 0.95, commission: float = 0.0,
             keys: Sequence[str] = KEYS, seconds: int | None = None) -> DataFrame:
    """One row per filled long trade of the rule.

    A decision at one bar's close fills at the next bar's open. A trade ends at the first later
    bar whose close is at or below entry * (1 - stop_loss), or where ``leave`` holds; without
    such a bar, or without a bar after it, it stays open. The size is ``risk`` of the cash at
    the signal's close, so a jump of the next open beyond the cash leaves the order unfilled.
    An entry while a trade is open is ignored; ``episode_id`` numbers all entries.
    """
    enter = F.col("cross") == 1 if enter is None else enter
    leave = F.col("cross") == -1 if leave is None else leave
    stop_loss = F.lit(stop_loss) if isinstance(stop_loss, float) else stop_loss
    chunk = chunk_of("timestamp", seconds)
    flagged = signals.select(*keys, "timestamp", "open", "close", *[
        F.coalesce(c, F.lit(False)).alias(n) for n, c in (("enters", enter), ("leaves", leave))],
        stop_loss.alias("stop"))
    exits = (F.col("leaves") & ~F.col("enters")).cast("int")
    placed = scan(flagged, keys, {
        "_bar": count(), "_next": following(F.struct(F.col("timestamp").alias("ts"), "open")),
        "episode_id": total(F.col("enters").cast("int")), "_exits": total(exits)}, chunk=chunk)
    signal = F.struct(
        "episode_id", F.col("timestamp").alias("signal_ts"), F.col("_bar").alias("signal_bar"),
        F.col("close").alias("signal_close"), F.col("_next.ts").alias("entry_ts"),
        F.col("_next.open").alias("entry_price"), "stop")
    # an exit signal belongs to the stretch that it ends
    tracked = scan(placed.withColumn("_segment", F.col("_exits") - exits), keys,
                   {"e": newest(F.when(F.col("enters"), signal))}, chunk=chunk).filter("episode_id > 0")
    earlier = Window.partitionBy(*keys, "episode_id").orderBy("timestamp").rowsBetween(
        Window.unboundedPreceding, -1)
    tracked = tracked.withColumn("_low", F.min("close").over(earlier))

    def end(reason: str) -> Column:
        return F.struct(
            F.col("_bar").alias("bar"), F.col("timestamp").alias("signal_ts"),
            F.col("_next.ts").alias("ts"), F.col("_next.open").alias("price"), F.lit(reason).alias("reason"))

    stopped = F.col("close") <= F.col("e.entry_price") * (1 - F.col("stop"))
    later = F.col("_bar") > F.col("e.signal_bar")
    is_low = F.col("_low").isNull() | (F.col("close") < F.col("_low"))
    own_end = F.when(stopped & later, end("stop")).when(F.col("leaves") & later, end("cross"))
    fits = F.lit(risk) * F.col("e.entry_price") * (1 + commission) <= F.col("e.signal_close")
    spans = tracked.groupBy(*keys, "episode_id").agg(
        F.min("_segment").alias("_segment"), F.max("e").alias("e"), F.min(own_end).alias("x"),
        F.min(F.when(F.col("leaves"), end("cross"))).alias("leave"),
        F.array_sort(F.collect_list(F.when(is_low, F.struct(
            F.col("_bar").alias("bar"), "close", end("stop").alias("x"))))).alias("lows"),
    ).withColumn("fits", F.coalesce(fits, F.lit(False)))
    closed = F.col("x.ts").isNotNull()

    def if_closed(c):
        return F.when(closed, c)
    gain = F.col("x.price") - F.col("e.entry_price")
    fee = F.lit(commission) * (F.col("x.price") + F.col("e.entry_price"))
    return _walk(spans, keys).select(
        *keys, "e.episode_id", "e.signal_ts", "e.signal_close", "e.entry_ts", "e.entry_price",
        (F.col("e.signal_bar") + 1).alias("entry_bar"),
        if_closed(F.col("x.signal_ts")).alias("exit_signal_ts"),
        F.col("x.ts").alias("exit_ts"),
        if_closed(F.col("x.price")).alias("exit_price"),
        if_closed(F.col("x.bar") + 1).alias("exit_bar"),
        if_closed(F.col("x.reason")).alias("exit_reason"),
        F.lit(risk).alias("risk"),
        if_closed(1 + F.lit(risk) / F.col("e.signal_close") * (gain - fee)).alias("factor"))


def equity(trades: DataFrame, cash: float = 10_000.0, keys: Sequence[str] = KEYS) -> DataFrame:
    """Cash before and after each trade, its size and its profit.

    Cash compounds as a running product, taken as the exponential of summed logarithms; a
    factor of zero ruins the run, which then stays at zero. An open trade leaves cash as it is.
    """
    upto = Window.partitionBy(*keys).orderBy("episode_id").rowsBetween(
        Window.unboundedPreceding, 0)
    order = Window.partitionBy(*keys).orderBy("episode_id")
    alive = F.when(F.col("factor") > 0, F.ln("factor")).otherwise(F.lit(0.0))
    ruined = F.max(F.coalesce(F.col("factor") <= 0, F.lit(False))).over(upto)
    after = F.when(ruined, F.lit(0.0)).otherwise(F.lit(cash) * F.exp(F.sum(alive).over(upto)))
    return (
        trades.withColumn("cash_after", after)
        .withColumn("cash_before", F.lag("cash_after", 1, cash).over(order))
        .withColumns({
            "size": F.col("risk") * F.col("cash_before") / F.col("signal_close"),
            "pnl": F.when(F.col("exit_ts").isNotNull(),
                          F.col("cash_after") - F.col("cash_before"))})
    )


def equity_curve(bars: DataFrame, trades: DataFrame, cash: float = 10_000.0,
                 keys: Sequence[str] = KEYS) -> DataFrame:
    """Account value and position value at every bar's close; ``trades`` from :func:`equity`."""
    opened = trades.select(*keys, F.col("entry_ts").alias("timestamp"), F.struct(
        "entry_price", "exit_ts", "size", "cash_before", "cash_after").alias("opened"))
    upto = _by_time(keys).rowsBetween(Window.unboundedPreceding, 0)
    current = F.last("opened", ignorenulls=True).over(upto)
    holding = F.col("t").isNotNull() & (
        F.col("t.exit_ts").isNull() | (F.col("timestamp") < F.col("t.exit_ts")))
    held = F.col("t.cash_before") + F.col("t.size") * (F.col("close") - F.col("t.entry_price"))
    return (
        bars.select(*keys, "timestamp", "close")
        .join(opened, [*keys, "timestamp"], "left")
        .withColumn("t", current)
        .select(
            *keys, "timestamp", "close",
            F.when(holding, held).otherwise(F.coalesce("t.cash_after", F.lit(cash)))
            .alias("equity"),
            F.when(holding, F.col("t.size") * F.col("close")).otherwise(F.lit(0.0))
            .alias("position_value"))
    )


def param_grid(bars: DataFrame, params: Sequence[dict] | DataFrame, cash: float = 10_000.0,
               columns: dict[str, Column] | None = None, keys: Sequence[str] = KEYS,
               seconds: int | None = None) -> DataFrame:
    """One result row per market and parameter set, with optional user columns.

    ``params`` holds {fast, slow, stop_loss}, see :func:`parameter_sets`. A set that never traded
    keeps its cash.
    """
    names = ["fast", "slow", "stop_loss"]
    params, _ = parameter_sets(params)
    params, sets = parameter_sets([{name: p[name] for name in names} for p in params])
    run = [*keys, "param_id", *names]
    signals = crossings(bars, [{name: p[name] for name in names} for p in params], keys, seconds)
    trades = equity(episodes(signals, stop_loss=F.col("stop_loss"), keys=run, seconds=seconds), cash, run)
    found = trades.groupBy(*keys, "param_id").agg(
        F.count(F.lit(1)).alias("trades"),
        F.count_if(F.col("pnl") > 0).alias("won"),
        F.max_by("cash_after", "episode_id").alias("final_cash"))
    runs = bars.select(*keys).distinct().select(*keys, F.inline(sets))
    result = runs.join(found, [*keys, "param_id"], "left").fillna(
        {"trades": 0, "won": 0, "final_cash": cash})
    return result.select("*", *[c.alias(name) for name, c in (columns or {}).items()])


def param_grid_top(grid: DataFrame, by: str, n: int = 10, descending: bool = True) -> DataFrame:
    key = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    ties = [c for c in grid.columns if c != by]
    return grid.orderBy(key, *ties).limit(n)
