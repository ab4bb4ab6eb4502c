"""Read-out queries over the serving tables, and the latest-value snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.functions.parameters import (
    DEFAULT_INTERVALS,
    DEFAULT_SYMBOLS,
    calendar_day,
    instant,
    one_of,
)
from candlelake.plans.serving import HISTORY_COLUMNS
from candlelake.schema import SERIES_KEY, project

# What each read-out answers with.
HISTORY_FIELDS = [*HISTORY_COLUMNS]
LATEST_FIELDS = [*HISTORY_COLUMNS, "updated_at"]
SIGNAL_FIELDS = [
    "symbol",
    "base_interval",
    "open_time",
    "close_time",
    "close",
    "volume",
    "rsi_14_1m",
    "macd_1m",
    "trend_15m",
    "rsi_14_15m",
    "macd_15m",
    "trend_1h",
    "rsi_14_1h",
    "macd_1h",
    "signal_score",
    "signal_label",
    "generated_at",
]
DAILY_SUMMARY_FIELDS = [
    "symbol",
    "event_date",
    "open_price",
    "close_price",
    "high_price",
    "low_price",
    "daily_volume",
    "avg_rsi_14",
    "avg_macd",
    "volatility_score",
    "generated_at",
]

# A cached latest value lives for seven days.
CACHE_TTL_DAYS = 7
SECONDS_PER_DAY = 86400


EPOCH = datetime(1970, 1, 1, tzinfo=UTC)
ONE_DAY = timedelta(days=1)


def _moment(bound: datetime) -> Column:
    return F.timestamp_micros(F.lit((bound - EPOCH) // timedelta(microseconds=1)))


def time_range(
    frame: DataFrame,
    start: str | None,
    end: str | None,
    *,
    column: str = "open_time",
    date_column: str | None = "event_date",
) -> DataFrame:
    """Rows with ``start <= column <= end``.

    The range of days this implies is stated too, so a table partitioned by day reads only those days. Days follow
    the zone of the session that wrote them, so the range is a day wider on each side.
    """
    dated = date_column is not None and date_column in frame.columns
    first, last = instant("from", start), instant("to", end)
    if first is not None:
        frame = frame.filter(F.col(column) >= _moment(first))
        frame = frame.filter(F.col(date_column) >= F.lit((first - ONE_DAY).date())) if dated else frame
    if last is not None:
        frame = frame.filter(F.col(column) <= _moment(last))
        frame = frame.filter(F.col(date_column) <= F.lit((last + ONE_DAY).date())) if dated else frame
    return frame


def date_range(
    frame: DataFrame, start: str | None, end: str | None, column: str = "event_date"
) -> DataFrame:
    days = (calendar_day("from", start), Column.__ge__), (calendar_day("to", end), Column.__le__)
    for day, keeps in days:
        frame = frame if day is None else frame.filter(keeps(F.col(column), F.lit(day)))
    return frame


def history_query(
    indicators: DataFrame,
    symbol: str | None,
    interval: str | None,
    *,
    start: str | None = None,
    end: str | None = None,
    limit: int | None = None,
    before: str | None = None,
    symbols: Sequence[str] = DEFAULT_SYMBOLS,
    intervals: Sequence[str] = DEFAULT_INTERVALS,
) -> DataFrame:
    """Candles of one series, newest first; all of them unless ``limit`` is given.

    ``before`` is the last open_time of the page before this one (see ``next_before``).
    """
    symbol, interval = one_of(symbols, symbol=symbol), one_of(intervals, interval=interval)
    rows = indicators.filter((F.col("symbol") == symbol) & (F.col("interval") == interval))
    return _newest(time_range(rows, start, end), HISTORY_FIELDS, "open_time", limit, before)


def signals_query(
    signals: DataFrame,
    symbol: str | None,
    *,
    start: str | None = None,
    end: str | None = None,
    limit: int | None = None,
    before: str | None = None,
    symbols: Sequence[str] = DEFAULT_SYMBOLS,
) -> DataFrame:
    """Multi-timeframe signals of one symbol, newest first."""
    rows = signals.filter(F.col("symbol") == one_of(symbols, symbol=symbol))
    return _newest(time_range(rows, start, end), SIGNAL_FIELDS, "open_time", limit, before)


def daily_summary_query(
    summaries: DataFrame,
    symbol: str | None,
    *,
    start: str | None = None,
    end: str | None = None,
    limit: int | None = None,
    before: str | None = None,
    symbols: Sequence[str] = DEFAULT_SYMBOLS,
) -> DataFrame:
    """Daily summaries of one symbol, newest first."""
    rows = summaries.filter(F.col("symbol") == one_of(symbols, symbol=symbol))
    return _newest(date_range(rows, start, end), DAILY_SUMMARY_FIELDS, "event_date", limit, before)


def _newest(
    rows: DataFrame, fields: list[str], order: str, limit: int | None, before: str | None
) -> DataFrame:
    if before:
        # Keyset paging. Rows older than a moment lie in its day or earlier ones, which prunes the table.
        seen = F.lit(before).cast(rows.schema[order].dataType)
        rows = rows.filter(F.col(order) < seen)
        if order != "event_date" and "event_date" in rows.columns:
            rows = rows.filter(F.col("event_date") <= F.date_add(seen.cast("date"), 1))
    ordered = project(rows, fields).orderBy(F.col(order).desc())
    return ordered if limit is None else ordered.limit(limit)


def next_before(page: DataFrame, limit: int, order: str = "open_time") -> str | None:
    """``before`` of the page after this one, or None where this one is not full."""
    rows, last = page.agg(F.count(F.lit(1)), F.min(order).cast("string")).first()
    return last if rows >= limit else None


def latest_snapshot(
    latest: DataFrame, *, now: Column | None = None, ttl_days: int = CACHE_TTL_DAYS
) -> DataFrame:
    """Latest values with the epoch second at which each expires."""
    now = F.current_timestamp() if now is None else now
    expiry = F.unix_seconds(now.cast("timestamp")) + F.lit(ttl_days * SECONDS_PER_DAY)
    return project(latest, LATEST_FIELDS).withColumn("expires_at_epoch", expiry.cast("bigint"))


def merge_snapshot(snapshot: DataFrame, update: DataFrame, *, now: Column | None = None) -> DataFrame:
    """Keyed put: updated series replace their entry, others stay until they expire."""
    now = F.current_timestamp() if now is None else now
    alive = snapshot.filter(F.col("expires_at_epoch") > F.unix_seconds(now.cast("timestamp")))
    kept = alive.join(update.select(*SERIES_KEY), on=list(SERIES_KEY), how="left_anti")
    return kept.unionByName(update)


def latest_lookup(
    snapshot: DataFrame,
    symbol: str | None,
    interval: str | None,
    *,
    symbols: Sequence[str] = DEFAULT_SYMBOLS,
    intervals: Sequence[str] = DEFAULT_INTERVALS,
) -> DataFrame:
    """The snapshot row of one series, no row if there is none."""
    symbol, interval = one_of(symbols, symbol=symbol), one_of(intervals, interval=interval)
    return snapshot.filter((F.col("symbol") == symbol) & (F.col("interval") == interval))


def latest_metric(snapshot: DataFrame, symbol: str | None, interval: str | None, **allowed) -> dict:
    """The snapshot row of one series as a dict; ``LookupError`` if there is none."""
    rows = latest_lookup(snapshot, symbol, interval, **allowed).limit(1).collect()
    if not rows:
        raise LookupError("Latest metric not found")
    return rows[0].asDict()
