"""Fixed schemas. Nothing is inferred: 76-digit token ids would turn into doubles."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D, _B, _TS = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


MARKETS = _struct(
    ("createdAt", _S), ("id", _S), ("question", _S), ("answer1", _S), ("answer2", _S),
    ("neg_risk", _B), ("market_slug", _S), ("token1", _S), ("token2", _S),
    ("condition_id", _S), ("volume", _D), ("ticker", _S), ("closedTime", _S),
)

FILLS = _struct(
    ("id", _S), ("timestamp", _L), ("maker", _S), ("makerAssetId", _S), ("makerAmountFilled", _L),
    ("taker", _S), ("takerAssetId", _S), ("takerAmountFilled", _L), ("transactionHash", _S),
)

TRADES = _struct(
    ("id", _S), ("timestamp", _TS), ("market_id", _S), ("maker", _S), ("taker", _S),
    ("nonusdc_side", _S), ("maker_direction", _S), ("taker_direction", _S), ("price", _D),
    ("usd_amount", _D), ("token_amount", _D), ("transactionHash", _S), ("is_matched", _B),
)

BARS = _struct(
    ("market_id", _S), ("timestamp", _TS), ("open", _D), ("high", _D), ("low", _D),
    ("close", _D), ("volume", _D),
)

LEADERBOARD = _struct(("user_id", _S), ("user_name", _S))

# Landed market objects. ``outcomes`` and ``clobTokenIds`` arrive as JSON text or as an array;
# a string field takes both, since the JSON reader keeps a nested value as its raw text.
MARKET_JSON = _struct(
    ("id", _S), ("createdAt", _S), ("question", _S), ("title", _S), ("slug", _S),
    ("conditionId", _S), ("volume", _S), ("closedTime", _S), ("outcomes", _S),
    ("clobTokenIds", _S), ("negRiskAugmented", _B), ("negRiskOther", _B),
    ("events", T.ArrayType(_struct(("ticker", _S)))),
)

# Numbers in landed events come as text.
EVENT_JSON = _struct(
    ("id", _S), ("timestamp", _S), ("maker", _S), ("makerAmountFilled", _S), ("makerAssetId", _S),
    ("taker", _S), ("takerAmountFilled", _S), ("takerAssetId", _S), ("transactionHash", _S),
    ("fee", _S), ("orderHash", _S),
)
EVENT_PAGE_JSON = _struct(("data", _struct(("orderFilledEvents", T.ArrayType(EVENT_JSON)))))
