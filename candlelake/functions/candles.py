"""Scalar expressions on candle columns: intervals, keys, trends and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from candlelake.schema import KEY_SEPARATOR, UNKNOWN_KEY_PART

# Seconds per interval unit (s, m, h, d, w, M).
UNIT_SECONDS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800, "M": 2592000}

# Event ids and the source label of normalized exchange rows.
EVENT_ID_PREFIX = "binance"
CANDLE_SOURCE = "binance-rest"

UP, DOWN, NEUTRAL = "up", "down", "neutral"


def interval_seconds(label: Column | str) -> Column:
    """Seconds in an interval label such as ``15m``; 1 for a label that is not a count and a unit."""
    label = F.col(label) if isinstance(label, str) else label
    unit = F.right(label, F.lit(1))
    seconds = F.lit(None).cast("bigint")
    for name, length in UNIT_SECONDS.items():
        seconds = F.when(unit == name, F.lit(length)).otherwise(seconds)
    count = F.left(label, F.length(label) - 1).try_cast("int")
    return F.when(count.between(1, 9999), F.coalesce(count * seconds, F.lit(1))).otherwise(1).cast("bigint")


def key_part(key: Column | str, position: int) -> Column:
    """Part of a ``symbol|interval`` message key by position, ``_unknown`` when the key has no such part."""
    parts = F.split(F.col(key) if isinstance(key, str) else key, r"\|")
    return F.coalesce(F.try_element_at(parts, F.lit(position + 1)), F.lit(UNKNOWN_KEY_PART))


def partition_key(symbol: Column | str = "symbol", interval: Column | str = "interval") -> Column:
    return F.concat_ws(KEY_SEPARATOR, symbol, interval)


def event_id(symbol: Column, interval: Column, open_time_ms: Column) -> Column:
    return F.concat_ws(":", F.lit(EVENT_ID_PREFIX), symbol, interval, open_time_ms.cast("string"))


def trend_label(close: Column, average: Column) -> Column:
    """``up`` above the average, ``down`` below it, otherwise (equal or missing) ``neutral``."""
    return F.when(close > average, F.lit(UP)).when(close < average, F.lit(DOWN)).otherwise(F.lit(NEUTRAL))


def macd_vote(macd: Column) -> Column:
    return F.when(macd > 0, F.lit(1)).when(macd < 0, F.lit(-1)).otherwise(F.lit(0))


def signal_score(*macds: Column) -> Column:
    """Sum of the signs of the MACDs; a missing MACD counts 0."""
    score = macd_vote(macds[0])
    for macd in macds[1:]:
        score = score + macd_vote(macd)
    return score


def signal_label(score: Column) -> Column:
    return (
        F.when(score >= 2, F.lit("bullish"))
        .when(score <= -2, F.lit("bearish"))
        .otherwise(F.lit("neutral"))
    )
