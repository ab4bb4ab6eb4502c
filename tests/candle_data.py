"""Candle fixtures shared by the tests."""

from datetime import UTC, datetime, timedelta

# A candle of the contract, and the bars that the golden indicator values belong to.
CANDLE = {
    "event_id": "binance:BTCUSDC:1m:1700000000000",
    "source": "binance-rest",
    "symbol": "BTCUSDC",
    "interval": "1m",
    "open_time": datetime(2023, 11, 14, 22, 13, 20, tzinfo=UTC),
    "close_time": datetime(2023, 11, 14, 22, 14, 19, 999000, tzinfo=UTC),
    "open": 10.0,
    "high": 12.0,
    "low": 9.0,
    "close": 11.0,
    "volume": 42.0,
    "quote_asset_volume": 450.0,
    "number_of_trades": 17,
    "taker_buy_base_asset_volume": 20.0,
    "taker_buy_quote_asset_volume": 215.0,
    "is_closed": True,
    "ingested_at": datetime(2023, 11, 14, 22, 14, 20, tzinfo=UTC),
}

PROCESSED_AT = datetime(2025, 1, 2)


def bar(symbol, interval, open_time, close, span, volume=10.0, spread=1.0):
    return (
        symbol,
        interval,
        open_time,
        open_time + span,
        float(close),
        float(close) + spread,
        float(close) - spread,
        float(close),
        float(volume),
    )


def golden_rows():
    """30 one-minute bars closing at 1 to 30, two 15-minute bars and two one-hour bars."""
    day = datetime(2025, 1, 1)
    minute, quarter, hour = (timedelta(seconds=s) for s in (59, 899, 3599))
    rows = [bar("BTCUSDC", "1m", day.replace(hour=1, minute=i), i + 1, minute) for i in range(30)]
    rows.append(bar("BTCUSDC", "15m", day.replace(minute=45), 100, quarter, 150, 5))
    rows.append(bar("BTCUSDC", "15m", day.replace(hour=1, minute=15), 120, quarter, 180, 5))
    rows.append(bar("BTCUSDC", "1h", day, 200, hour, 600, 5))
    rows.append(bar("BTCUSDC", "1h", day.replace(hour=1), 220, hour, 620, 5))
    return rows
