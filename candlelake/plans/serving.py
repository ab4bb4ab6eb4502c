"""Serving tables: indicator history, latest value per series, multi-timeframe signals, daily summary."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.functions.candles import interval_seconds, signal_label, signal_score, trend_label
from candlelake.operators.asof import asof_contexts
from candlelake.operators.scan import CHUNK_CANDLES
from candlelake.schema import GOLD_COLUMNS, SERIES_KEY

GOLD_VIEW = "gold_market_indicators"
HISTORY_COLUMNS = [*GOLD_COLUMNS, "event_date"]


@dataclass(frozen=True)
class ServingContext:
    """Parameters of the serving tables."""

    base_interval: str = "1m"
    context_intervals: tuple[str, ...] = ("15m", "1h")
    processing_timestamp: datetime | None = None
    match_on: str = "open_time"
    measured: bool = False

    def __post_init__(self) -> None:
        if len(self.context_intervals) != 2:
            raise ValueError("context_intervals must contain exactly two values")
        if self.match_on not in ("open_time", "close_time"):
            raise ValueError("match_on must be open_time or close_time")

    def processed_at(self) -> Column:
        if self.processing_timestamp is None:
            return F.current_timestamp()
        return F.lit(self.processing_timestamp).cast("timestamp")


def market_indicators(gold: DataFrame, context: ServingContext) -> DataFrame:
    return gold.select(*HISTORY_COLUMNS, context.processed_at().alias("loaded_at"))


def market_indicators_latest(gold: DataFrame, context: ServingContext) -> DataFrame:
    """Newest row per series.

    One fixed-width ``max_by`` per column makes this a hash aggregation: a series is reduced to one row
    per task before the shuffle, without a sort.
    """
    values = [name for name in HISTORY_COLUMNS if name not in (*SERIES_KEY, "open_time")]
    newest = gold.groupBy(*SERIES_KEY).agg(
        F.max("open_time").alias("open_time"),
        *[F.max_by(name, "open_time").alias(name) for name in values],
    )
    return newest.select(*HISTORY_COLUMNS, context.processed_at().alias("updated_at"))


def market_multitimeframe_signals(gold: DataFrame, context: ServingContext) -> DataFrame:
    """Base candles with trend, RSI and MACD of the two context intervals as of each candle.

    With ``match_on="open_time"`` a context candle counts from its opening on, before it is complete. Chunks span as many
    base candles as a task should see; with ``context.measured`` they are cut by counting the rows of Gold.
    """
    first, second = context.context_intervals
    chunks = None if context.measured else interval_seconds(F.lit(context.base_interval)) * CHUNK_CANDLES
    interval = F.col("interval")
    joined = asof_contexts(
        gold.select("symbol", "interval", "open_time", "close_time", "close", "volume", "ema_26", "rsi_14", "macd"),
        by=["symbol"],
        is_left=interval == context.base_interval,
        time="open_time",
        context_time=context.match_on,
        contexts={"_first": interval == first, "_second": interval == second},
        columns=["close", "ema_26", "rsi_14", "macd"],
        chunk_seconds=chunks,
    )
    one, two = F.col("_first"), F.col("_second")
    score = signal_score(F.col("macd"), one["macd"], two["macd"])
    return joined.select(
        "symbol",
        F.lit(context.base_interval).alias("base_interval"),
        "open_time",
        "close_time",
        "close",
        "volume",
        F.col("rsi_14").alias("rsi_14_1m"),
        F.col("macd").alias("macd_1m"),
        trend_label(one["close"], one["ema_26"]).alias("trend_15m"),
        one["rsi_14"].alias("rsi_14_15m"),
        one["macd"].alias("macd_15m"),
        trend_label(two["close"], two["ema_26"]).alias("trend_1h"),
        two["rsi_14"].alias("rsi_14_1h"),
        two["macd"].alias("macd_1h"),
        score.alias("signal_score"),
        signal_label(score).alias("signal_label"),
        context.processed_at().alias("generated_at"),
    )


def market_daily_summary(gold: DataFrame, context: ServingContext) -> DataFrame:
    """Open, close, range, volume, mean indicators and volatility per symbol and day of base candles."""
    return (
        gold.filter(F.col("interval") == context.base_interval)
        .groupBy("symbol", "event_date")
        .agg(
            F.min_by("open", "open_time").alias("open_price"),
            F.max_by("close", "open_time").alias("close_price"),
            F.max("high").alias("high_price"),
            F.min("low").alias("low_price"),
            F.sum("volume").alias("daily_volume"),
            F.avg("rsi_14").alias("avg_rsi_14"),
            F.avg("macd").alias("avg_macd"),
            F.coalesce(F.stddev_samp("close"), F.lit(0.0)).alias("volatility_score"),
        )
        .withColumn("generated_at", context.processed_at())
    )


@dataclass(frozen=True)
class ServingTable:
    name: str
    build: Callable[[DataFrame, ServingContext], DataFrame]
    target_option: str
    partition_columns: tuple[str, ...] = ()
    mode: str = "overwrite"


# Names, option names and partitions of the serving tables.
SERVING_TABLES = (
    ServingTable(
        "market_indicators",
        market_indicators,
        "DATAMART_INDICATORS_TABLE",
        ("event_date", "symbol", "interval"),
    ),
    ServingTable("market_indicators_latest", market_indicators_latest, "DATAMART_LATEST_TABLE"),
    ServingTable(
        "market_multitimeframe_signals",
        market_multitimeframe_signals,
        "DATAMART_MULTITIMEFRAME_TABLE",
    ),
    ServingTable(
        "market_daily_summary",
        market_daily_summary,
        "DATAMART_DAILY_SUMMARY_TABLE",
        ("event_date", "symbol"),
    ),
)


def materialize_serving_tables(
    gold: DataFrame,
    context: ServingContext,
    tables: Iterable[ServingTable] = SERVING_TABLES,
) -> list[tuple[ServingTable, DataFrame]]:
    """Each serving table with its (lazy) frame; Gold is also registered as a view for SQL users."""
    gold.createOrReplaceTempView(GOLD_VIEW)
    return [(table, table.build(gold, context)) for table in tables]


def register_serving_views(gold: DataFrame, context: ServingContext) -> Sequence[str]:
    """Register every serving table as a temporary view under its own name."""
    built = materialize_serving_tables(gold, context)
    for table, frame in built:
        frame.createOrReplaceTempView(table.name)
    return [table.name for table, _ in built]
