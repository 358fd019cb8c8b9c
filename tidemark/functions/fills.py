"""Column expressions over one raw order fill."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The id of the cash asset, its label, and the exchange's own wallets.
USDC_ASSET = "0"
USDC = "USDC"
PLATFORM_WALLETS = (
    "0xc5d563a36ae78145c45a50134d48a1215220f80a",
    "0x4bfb41d5b3570defd03c39a9a4d8de6bd8b8982e",
)


def nonusdc_asset() -> Column:
    """The outcome token of a fill; the maker's asset wins when neither side is cash."""
    return F.when(F.col("makerAssetId") != USDC_ASSET, F.col("makerAssetId")).otherwise(
        F.col("takerAssetId"))


def taker_pays_cash() -> Column:
    return F.coalesce(F.col("takerAssetId") == USDC_ASSET, F.lit(False))


def direction(buys: Column) -> Column:
    return F.when(buys, F.lit("BUY")).otherwise(F.lit("SELL"))


def involves(wallets, *roles: str) -> Column:
    """True where any of the given role columns holds one of the wallets."""
    return reduce(lambda a, b: a | b, [F.col(role).isin(list(wallets)) for role in roles])


def is_platform(*roles: str) -> Column:
    return involves(PLATFORM_WALLETS, *(roles or ("maker", "taker")))
