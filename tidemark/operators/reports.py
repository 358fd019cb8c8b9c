"""Backtest reports as tables, one result per run.

``curve`` comes from ``signals.equity_curve`` and ``trades`` from ``signals.equity``. Both hold
bars or trades of bars, whose number per run the calendar bounds (see ``signals``); for longer ones
``seconds``, or ``size`` for trades, cuts running results into chunks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.chunks import chunk_of, count, highest, newest, scan, total

KEYS = ("market_id",)
_STREAKS = ("won_current", "won_longest", "lost_current", "lost_longest")


def time_return(curve: DataFrame, period: str = "day", cash: float = 10_000.0,
                keys: Sequence[str] = KEYS) -> DataFrame:
    """Return per period: its last value over the previous period's last value, less one."""
    ends = curve.groupBy(*keys, F.date_trunc(period, "timestamp").alias("period")).agg(
        F.max_by("equity", "timestamp").alias("equity"))
    before = F.lag("equity", 1, cash).over(Window.partitionBy(*keys).orderBy("period"))
    return ends.withColumn("period_return", F.try_divide(F.col("equity"), before) - 1)


def annual_return(curve: DataFrame, cash: float = 10_000.0,
                  keys: Sequence[str] = KEYS) -> DataFrame:
    yearly = time_return(curve, "year", cash, keys)
    return yearly.select(*keys, F.year("period").alias("year"),
                         F.col("period_return").alias("annual_return"))


def drawdown_curve(curve: DataFrame, column: str = "equity", keys: Sequence[str] = KEYS,
                   seconds: int | None = None) -> DataFrame:
    """Distance from the running peak per bar: money, percent, and bars since the peak."""
    value = F.col(column)
    chunk = chunk_of("timestamp", seconds)
    numbered = scan(curve, keys, {"_bar": count()}, chunk=chunk)
    # the latest bar of the largest value so far
    top = highest(F.when(value.isNotNull(), F.struct(value.alias("value"), F.col("_bar").alias("bar"))))
    return scan(numbered, keys, {"_top": top}, chunk=chunk).withColumns({
        "peak": F.col("_top.value"),
        "length": F.col("_bar") - F.col("_top.bar"),
        "moneydown": F.col("_top.value") - value,
        "drawdown": F.try_divide(F.col("_top.value") - value, F.col("_top.value")) * 100,
    }).drop("_bar", "_top")


def drawdown(curve: DataFrame, column: str = "equity", keys: Sequence[str] = KEYS,
             seconds: int | None = None) -> DataFrame:
    """Current and largest drawdown of each run."""
    fields = ["length", "moneydown", "drawdown"]
    now = F.max_by(F.struct(*fields), "timestamp").alias("now")
    deep = drawdown_curve(curve, column, keys, seconds).groupBy(*keys).agg(
        now, *[F.max(f).alias(f"max_{f}") for f in fields])
    return deep.select(*keys, "now.*", *[f"max_{f}" for f in fields])


def sharpe(returns: DataFrame, riskfree: float = 0.0, periods: int | None = None,
           keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean excess return over its sample deviation; ``periods`` per year annualises it."""
    excess = F.col("period_return") - riskfree
    ratio = F.try_divide(F.avg(excess), F.stddev_samp(excess))
    if periods:
        ratio = ratio * F.sqrt(F.lit(float(periods)))
    return returns.groupBy(*keys).agg(ratio.alias("sharpe_ratio"))


def calmar(curve: DataFrame, cash: float = 10_000.0, keys: Sequence[str] = KEYS) -> DataFrame:
    """Per month: yearly log return so far over the largest drawdown so far."""
    months = (
        drawdown_curve(curve, "equity", keys)
        .groupBy(*keys, F.date_trunc("month", "timestamp").alias("month"))
        .agg(F.max_by("equity", "timestamp").alias("equity"),
             (F.max("drawdown") / 100).alias("deepest")))
    w = Window.partitionBy(*keys).orderBy("month")
    years = F.row_number().over(w) / 12
    growth = F.when(F.col("equity") > 0, F.ln(F.col("equity") / cash))
    worst = F.max("deepest").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return months.select(*keys, "month", F.try_divide(growth / years, worst).alias("calmar"))


def sqn(trades: DataFrame, keys: Sequence[str] = KEYS, runs: DataFrame | None = None) -> DataFrame:
    """System quality number over closed trades; ``runs`` as for :func:`streaks`."""
    closed = trades.filter(F.col("pnl").isNotNull())
    n = F.count(F.lit(1))
    found = closed.groupBy(*keys).agg(
        (F.sqrt(n) * F.try_divide(F.avg("pnl"), F.stddev_samp("pnl"))).alias("sqn"),
        n.alias("trades"))
    return for_all(runs, found, keys, ["trades"])


def vwr(returns: DataFrame, tann: float = 252.0, sdev_max: float = 0.20, tau: float = 2.0,
        cash: float = 10_000.0, keys: Sequence[str] = KEYS) -> DataFrame:
    """Variability-weighted return.

    The yearly compound return in percent, scaled by 1 - (s / sdev_max) ** tau, where s is the
    sample deviation of actual over ideal value (steady growth) less one. A run whose s exceeds
    ``sdev_max`` scores zero.
    """
    w = Window.partitionBy(*keys).orderBy("period")
    whole = Window.partitionBy(*keys)
    last = F.last("equity").over(w.rowsBetween(Window.unboundedPreceding,
                                               Window.unboundedFollowing))
    per_period = (
        returns.withColumns({
            "_i": F.row_number().over(w), "_n": F.count(F.lit(1)).over(whole), "_last": last})
        .withColumn("_rate", F.ln(F.col("_last") / cash) / F.col("_n"))
        .withColumn("_off", F.col("equity") / (cash * F.exp(F.col("_rate") * F.col("_i"))) - 1)
    )
    spread = F.col("variability")
    yearly = (F.exp(F.col("rate") * tann) - 1) * 100
    weight = 1 - F.pow(spread / sdev_max, F.lit(tau))
    return (
        per_period.groupBy(*keys)
        .agg(F.max("_rate").alias("rate"), F.stddev_samp("_off").alias("variability"))
        .select(*keys, "rate", "variability",
                F.when(spread <= sdev_max, yearly * weight).when(spread > sdev_max, 0.0)
                .alias("vwr"))
    )


def gross_leverage(curve: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Position value over account value at every bar."""
    return curve.select(*keys, "timestamp",
                        F.try_divide("position_value", "equity").alias("leverage"))


def transactions(trades: DataFrame, instrument: str = "market_id",
                 keys: Sequence[str] = KEYS) -> DataFrame:
    """A buy row per trade and a sell row per closed trade."""
    def row(ts: str, size: Column, price: str):
        return F.struct(F.col(ts).alias("timestamp"), size.alias("size"),
                        F.col(price).alias("price"))
    both = F.array(row("entry_ts", F.col("size"), "entry_price"),
                   row("exit_ts", -F.col("size"), "exit_price"))
    keep = [k for k in keys if k != instrument]
    return (
        trades.select(*keep, "episode_id", F.col(instrument).alias("instrument"), F.inline(both))
        .filter(F.col("timestamp").isNotNull())
        .withColumn("value", -F.col("size") * F.col("price"))
    )


def for_all(runs: DataFrame | None, report: DataFrame, keys: Sequence[str],
            zeros: Sequence[str]) -> DataFrame:
    """The report with a row for each of ``runs``; one without a row gets zeros and nulls."""
    if runs is None:
        return report
    return runs.select(*keys).distinct().join(report, list(keys), "left").fillna(0, list(zeros))


def streaks(trades: DataFrame, keys: Sequence[str] = KEYS, runs: DataFrame | None = None,
            size: int | None = None) -> DataFrame:
    """Current and longest run of won and of lost closed trades; a profit of zero counts as won.

    ``runs`` lists the keys that get a row even without a closed trade; ``size`` is the number of
    trades of a run that are ordered together, all of them by default.
    """
    chunk, order = None if size is None else F.floor(F.col("episode_id") / size), ["episode_id"]
    closed = trades.filter(F.col("pnl").isNotNull()).withColumn("won", F.col("pnl") >= 0)
    turns = scan(closed, keys, {"_was": newest(F.col("won"), before=True)}, order, chunk)
    turned = F.coalesce(F.col("_was") != F.col("won"), F.lit(True)).cast("int")
    islands = (
        scan(turns, keys, {"_island": total(turned)}, order, chunk)
        .groupBy(*keys, "won", "_island").agg(F.count(F.lit(1)).alias("n"))
    )
    last = F.max_by(F.struct("won", "n"), "_island").alias("last")
    def longest(kind):
        return F.coalesce(F.max(F.when(kind, F.col("n"))), F.lit(0))
    def current(kind):
        return F.when(kind, F.col("last.n")).otherwise(F.lit(0))
    found = islands.groupBy(*keys).agg(
        last, longest(F.col("won")).alias("won_longest"), longest(~F.col("won")).alias("lost_longest")
    ).select(
        *keys, current(F.col("last.won")).alias("won_current"), "won_longest",
        current(~F.col("last.won")).alias("lost_current"), "lost_longest")
    return for_all(runs, found, keys, _STREAKS)


def trade_analysis(trades: DataFrame, keys: Sequence[str] = KEYS, runs: DataFrame | None = None
                   ) -> DataFrame:
    """Counts, streaks, profit and length of trades by direction and outcome.

    The rule only buys, so everything about short trades is zero or null. ``runs`` lists the
    keys that get a row even without a trade.
    """
    is_closed = F.col("exit_ts").isNotNull()
    won, lost = F.col("pnl") >= 0, F.col("pnl") < 0
    gross = F.col("size") * (F.col("exit_price") - F.col("entry_price"))
    bars = F.col("exit_bar") - F.col("entry_bar")

    def money(name: str, value: Column, when: Column) -> list[Column]:
        kept = F.when(when, value)
        return [F.coalesce(F.sum(kept), F.lit(0.0)).alias(f"{name}_total"),
                F.avg(kept).alias(f"{name}_average")]

    def length(name: str, when: Column) -> list[Column]:
        kept = F.when(when, bars)
        return [F.coalesce(F.sum(kept), F.lit(0)).alias(f"{name}_total"),
                F.min(kept).alias(f"{name}_min"), F.max(kept).alias(f"{name}_max"),
                F.avg(kept).alias(f"{name}_average")]

    none = F.lit(False)
    stats = trades.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~is_closed).alias("open"),
        F.count_if(is_closed).alias("closed"),
        F.count_if(won).alias("won"),
        F.count_if(lost).alias("lost"),
        F.count_if(is_closed).alias("long_total"),
        F.count_if(won).alias("long_won"),
        F.count_if(lost).alias("long_lost"),
        F.count_if(none).alias("short_total"),
        F.count_if(none).alias("short_won"),
        F.count_if(none).alias("short_lost"),
        *money("pnl_gross", gross, is_closed),
        *money("pnl_net", F.col("pnl"), is_closed),
        *money("pnl_long", F.col("pnl"), is_closed),
        *money("pnl_long_won", F.col("pnl"), won),
        *money("pnl_long_lost", F.col("pnl"), lost),
        *money("pnl_short", F.col("pnl"), none),
        *money("pnl_short_won", F.col("pnl"), none),
        *money("pnl_short_lost", F.col("pnl"), none),
        *length("len_won", won),
        *length("len_lost", lost),
        *length("len_long", is_closed),
        *length("len_long_won", won),
        *length("len_long_lost", lost),
        *length("len_short", none),
        *length("len_short_won", none),
        *length("len_short_lost", none),
    )
    report = stats.join(streaks(trades, keys), list(keys), "left").fillna(0, list(_STREAKS))
    spread = ("_average", "_min", "_max")
    return for_all(runs, report, keys,
                   [c for c in report.columns if c not in keys and not c.endswith(spread)])


def period_stats(returns: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Shape of the period returns."""
    r = F.col("period_return")
    return returns.groupBy(*keys).agg(
        F.avg(r).alias("average"), F.stddev_pop(r).alias("stddev"),
        F.count_if(r > 0).alias("positive"), F.count_if(r < 0).alias("negative"),
        F.count_if(r == 0).alias("nochange"), F.max(r).alias("best"), F.min(r).alias("worst"))


def flatten_report(report: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """(label, value) rows of a nested result; nested names are joined with ' - '."""
    def leaves(schema: T.StructType, path: tuple[str, ...] = ()):
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                yield from leaves(field.dataType, here)
            else:
                yield here
    paths = [p for p in leaves(report.schema) if p[0] not in keys]
    rows = F.array(*[
        F.struct(F.lit(" - ".join(p)).alias("label"),
                 F.col(".".join(f"`{n}`" for n in p)).cast("string").alias("value"))
        for p in paths])
    return report.select(*keys, F.inline(rows))
