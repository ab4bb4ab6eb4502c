"""Exchange kline rows to candles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.functions.candles import CANDLE_SOURCE, event_id
from candlelake.schema import CANDLE_COLUMNS

KLINE_ROWS = "array<array<string>>"

# Positions in a kline row.
OPEN_TIME, OPEN, HIGH, LOW, CLOSE, VOLUME, CLOSE_TIME = 0, 1, 2, 3, 4, 5, 6
QUOTE_VOLUME, TRADES, TAKER_BASE, TAKER_QUOTE = 7, 8, 9, 10


def _at(row: Column, position: int) -> Column:
    return F.try_element_at(row, F.lit(position + 1))


def _millis(row: Column, position: int) -> Column:
    return _at(row, position).try_cast("bigint")


def parse_klines(polls: DataFrame, body: str = "body", output: str = "klines") -> DataFrame:
    """Parse a polled JSON array of kline rows; anything else gives NULL."""
    return polls.withColumn(output, F.from_json(F.col(body), KLINE_ROWS))


def pick_latest_closed(rows: Column, now_ms: Column) -> Column:
    """Last kline row whose close time has passed, the last row if none has."""
    closed = F.filter(rows, lambda row: _millis(row, CLOSE_TIME) < now_ms)
    return F.coalesce(F.try_element_at(closed, F.lit(-1)), F.try_element_at(rows, F.lit(-1)))


def normalize_klines(
    frame: DataFrame, *, row: str = "kline", now_ms: Column, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Kline rows (with ``symbol`` and ``interval``) to the 17 contract columns.

    A number that does not parse becomes NULL, which the quality rules reject later; it does not fail
    the job.
    """
    kline = F.col(row)
    open_ms, close_ms = _millis(kline, OPEN_TIME), _millis(kline, CLOSE_TIME)

    def number(position: int) -> Column:
        return _at(kline, position).try_cast("double")

    known = open_ms.isNotNull()
    return frame.withColumns(
        {
            "event_id": F.when(known, event_id(F.col("symbol"), F.col("interval"), open_ms)),
            "source": F.lit(CANDLE_SOURCE),
            "open_time": F.timestamp_millis(open_ms),
            "close_time": F.timestamp_millis(close_ms),
            "open": number(OPEN),
            "high": number(HIGH),
            "low": number(LOW),
            "close": number(CLOSE),
            "volume": number(VOLUME),
            "quote_asset_volume": number(QUOTE_VOLUME),
            "number_of_trades": _millis(kline, TRADES),
            "taker_buy_base_asset_volume": number(TAKER_BASE),
            "taker_buy_quote_asset_volume": number(TAKER_QUOTE),
            "is_closed": close_ms < now_ms,
            "ingested_at": F.timestamp_millis(now_ms),
        }
    ).select(*keep, *CANDLE_COLUMNS)


def latest_candles(polls: DataFrame, *, now_ms: Column, body: str = "body") -> DataFrame:
    """One candle per poll of a series: the latest closed row of its JSON body."""
    rows = parse_klines(polls, body, "_klines").withColumn(
        "_kline", pick_latest_closed(F.col("_klines"), now_ms)
    )
    return normalize_klines(rows.filter(F.col("_kline").isNotNull()), row="_kline", now_ms=now_ms)
