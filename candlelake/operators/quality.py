"""Row filters of the Silver layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns that each rule of the layer is about.
REQUIRED = (
    "event_id",
    "source",
    "symbol",
    "interval",
    "open_time",
    "close_time",
    "ingested_at",
    "event_date",
)
PRICES = ("open", "high", "low", "close")
AMOUNTS = (
    "volume",
    "quote_asset_volume",
    "number_of_trades",
    "taker_buy_base_asset_volume",
    "taker_buy_quote_asset_volume",
)


def ohlcv_rule() -> Column:
    """True for a usable candle. A NULL in any compared column makes it NULL, and a filter drops NULL."""
    high, low = F.col("high"), F.col("low")
    rules = [F.col(name).isNotNull() for name in REQUIRED]
    rules += [F.col(name) > 0 for name in PRICES]
    rules += [high >= F.col(name) for name in ("low", "open", "close")]
    rules += [low <= F.col(name) for name in ("open", "close")]
    rules += [F.col(name) >= 0 for name in AMOUNTS]
    return reduce(lambda left, right: left & right, rules)


def filter_closed_candles(frame: DataFrame) -> DataFrame:
    return frame.filter(F.col("is_closed"))


def apply_ohlcv_quality_rules(frame: DataFrame, reject_nan: bool = False) -> DataFrame:
    """Keep usable candles. NaN compares greater than any number, so it passes unless ``reject_nan``."""
    kept = frame.filter(ohlcv_rule())
    if reject_nan:
        for name in (*PRICES, *AMOUNTS):
            kept = kept.filter(~F.isnan(F.col(name).cast("double")))
    return kept


def apply_silver_quality_rules(frame: DataFrame, reject_nan: bool = False) -> DataFrame:
    return apply_ohlcv_quality_rules(filter_closed_candles(frame), reject_nan)
