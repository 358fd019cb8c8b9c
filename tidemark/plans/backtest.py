"""Bars to account curve for one rule."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame

from tidemark.operators.signals import KEYS, crossover, episodes, equity, equity_curve


class Backtest(NamedTuple):
    trades: DataFrame
    curve: DataFrame

    def runs(self, keys: Sequence[str] = KEYS) -> DataFrame:
        """Every run of the rule, also those that never traded."""
        return self.curve.select(*keys).distinct()


def moving_average_backtest(bars: DataFrame, fast: int = 50, slow: int = 200,
                            stop_loss: float = 0.02, risk: float = 0.95, cash: float = 10_000.0,
                            commission: float = 0.0, keys: Sequence[str] = KEYS) -> Backtest:
    signals = crossover(bars, fast, slow, keys)
    trades = equity(episodes(signals, stop_loss=stop_loss, risk=risk, commission=commission,
                             keys=keys), cash, keys)
    return Backtest(trades, equity_curve(bars, trades, cash, keys))
