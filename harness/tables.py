"""Candles, versions, messages and polls derived from the given tables, in Spark and in DuckDB SQL.

The given tables hold no candles, so events serve as trades: the event type is the symbol, the value is the
price. Defects (bad keys, broken payloads, open candles, negative prices, repeated messages) are put in by
event id. Every function reads its whole table.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.functions.candles import event_id, partition_key
from candlelake.schema import CANDLE_COLUMNS

INTERVALS = {"1m": 60, "15m": 900, "1h": 3600}
INGESTED_AT = datetime(2024, 2, 1, 12, 30)
TOPIC = "market-candles"
COPY_OFFSET = 1_000_000_000


def scratch(spark: SparkSession) -> str:
    """A new folder next to the session's checkpoints.

    Where the session names none, a session of one machine gets one of its own; on a cluster that is an error, since
    executors do not share local folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="candlelake-")
    return f"{base.rstrip('/')}/candlelake-{uuid.uuid4().hex}"


@contextmanager
def stateful_partitions(spark: SparkSession) -> Iterator[None]:
    """State stores in as many partitions as the session has cores, while a query runs."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


_STORED: dict[tuple[str, str, str], str] = {}


def stored(
    spark: SparkSession, sf_dir: str, layer: str, build: Callable[[SparkSession, str], DataFrame]
) -> DataFrame:
    """A layer as later jobs see it: written once per application, then read from its dataset."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    key = (spark.sparkContext.applicationId, sf_dir, layer)
    if key not in _STORED:
        path = scratch(spark)
        build(spark, sf_dir).write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _candle(frame: DataFrame, **columns: Column) -> DataFrame:
    """The contract columns from the given ones, the rest filled in the same way everywhere."""
    defaults = {
        "source": F.lit("binance-rest"),
        "quote_asset_volume": columns["volume"] * 2,
        "taker_buy_base_asset_volume": columns["volume"] * 0.5,
        "taker_buy_quote_asset_volume": columns["volume"],
    }
    full = {**defaults, **columns}
    full["event_id"] = event_id(full["symbol"], full["interval"], F.unix_millis(full["open_time"]))
    return frame.select(*[full[name].alias(name) for name in CANDLE_COLUMNS])


def _bucket(ts: Column, seconds: int) -> Column:
    return F.timestamp_seconds(F.floor(F.unix_seconds(ts) / seconds) * seconds)


def bars(spark: SparkSession, sf_dir: str, symbol: Column | None = None) -> DataFrame:
    """One-minute, 15-minute and one-hour candles of the events, with event_date."""
    symbol = F.upper("event_type") if symbol is None else symbol
    ts = F.col("ts").cast("timestamp")
    trades = read(spark, sf_dir, "events").select(
        symbol.alias("symbol"), ts.alias("ts"), "value"
    )
    # Each trade belongs to one bar per interval; one scan and one aggregation serve all three.
    labels = F.array(
        *[
            F.struct(F.lit(label).alias("interval"), F.lit(seconds).alias("seconds"), _bucket(F.col("ts"), seconds).alias("open_time"))
            for label, seconds in INTERVALS.items()
        ]
    )
    grouped = (
        trades.select("symbol", "ts", "value", F.inline(labels))
        .groupBy("symbol", "interval", "seconds", "open_time")
        .agg(
            F.min_by("value", "ts").alias("open"),
            F.max_by("value", "ts").alias("close"),
            F.max("value").alias("high"),
            F.min("value").alias("low"),
            F.count(F.lit(1)).alias("trades"),
        )
    )
    close_time = F.timestamp_millis(F.unix_millis("open_time") + F.col("seconds") * 1000 - 1)
    return _candle(
        grouped,
        symbol=F.col("symbol"),
        interval=F.col("interval"),
        open_time=F.col("open_time"),
        close_time=close_time,
        open=F.col("open"),
        high=F.col("high"),
        low=F.col("low"),
        close=F.col("close"),
        volume=F.col("trades").cast("double"),
        number_of_trades=F.col("trades"),
        is_closed=F.lit(True),
        ingested_at=close_time,
    ).withColumn("event_date", F.to_date("open_time"))


def bars_sql(symbol: str = "upper(event_type)") -> str:
    return f"""
bars AS (
  SELECT 'binance:' || symbol || ':' || interval || ':' || epoch_ms(open_time) AS event_id,
         'binance-rest' AS source, symbol, interval, open_time,
         open_time + to_milliseconds(seconds * 1000 - 1) AS close_time,
         open, high, low, close, trades::DOUBLE AS volume, trades * 2.0::DOUBLE AS quote_asset_volume,
         trades AS number_of_trades, trades * 0.5::DOUBLE AS taker_buy_base_asset_volume,
         trades::DOUBLE AS taker_buy_quote_asset_volume, TRUE AS is_closed,
         open_time + to_milliseconds(seconds * 1000 - 1) AS ingested_at, open_time::DATE AS event_date
  FROM (
    SELECT {symbol} AS symbol, interval, seconds,
           make_timestamp((epoch_us(ts) // (seconds * 1000000)) * seconds * 1000000) AS open_time,
           arg_min(value, ts) AS open, arg_max(value, ts) AS close, max(value) AS high, min(value) AS low,
           count(*) AS trades
    FROM events, (VALUES ('1m', 60::BIGINT), ('15m', 900::BIGINT), ('1h', 3600::BIGINT)) AS labels(interval, seconds)
    GROUP BY ALL
  )
)"""


BARS_SQL = bars_sql()


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily candles per supplier from lineitem: many series, sparse in time.

    Prices are square roots of extended prices, so that no mean of them ends in an exact decimal half.
    """
    price = F.sqrt("l_extendedprice")
    order = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")
    lines = read(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("open_time"),
        price.alias("price"),
        order.alias("trade"),
        "l_quantity",
    )
    grouped = lines.groupBy("symbol", "open_time").agg(
        F.min_by("price", "trade").alias("open"),
        F.max_by("price", "trade").alias("close"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("l_quantity").alias("volume"),
    )
    return grouped.select(
        "symbol",
        F.lit("1d").alias("interval"),
        "open_time",
        F.timestamp_millis(F.unix_millis("open_time") + 86_399_999).alias("close_time"),
        "open",
        "high",
        "low",
        "close",
        "volume",
    )


SUPPLIER_SQL = """
bars AS (
  SELECT 'S' || l_suppkey AS symbol, '1d' AS interval, l_shipdate AS open_time,
         l_shipdate + to_milliseconds(86399999) AS close_time,
         arg_min(sqrt(l_extendedprice), (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) AS open,
         max(sqrt(l_extendedprice)) AS high, min(sqrt(l_extendedprice)) AS low,
         arg_max(sqrt(l_extendedprice), (l_orderkey * 8 + l_linenumber) * 1000000 + l_partkey) AS close,
         sum(l_quantity) AS volume, l_shipdate::DATE AS event_date
  FROM lineitem GROUP BY l_suppkey, l_shipdate
)"""


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of 15-minute candles, one per event, with open candles and unusable prices among them."""
    number = F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    open_time = _bucket(ts, 900)
    value = F.when(number % 20 == 13, -F.col("value")).otherwise(F.col("value"))
    low = F.when(number % 20 == 14, F.lit(None).cast("double")).otherwise(value - 0.5)
    events = read(spark, sf_dir, "events")
    return _candle(
        events,
        symbol=F.upper("event_type"),
        interval=F.lit("15m"),
        open_time=open_time,
        close_time=F.timestamp_millis(F.unix_millis(open_time) + 899_999),
        open=value,
        high=F.when(number % 20 == 15, value - 1).otherwise(value + 0.5),
        low=low,
        close=value,
        volume=F.when(number % 20 == 16, F.lit(-1.0)).otherwise(F.lit(1.0)),
        number_of_trades=F.lit(1).cast("bigint"),
        is_closed=number % 20 != 11,
        ingested_at=ts,
    ).withColumn("event_date", F.to_date("open_time"))


VERSIONS_SQL = """
versions AS (
  SELECT 'binance:' || symbol || ':15m:' || epoch_ms(open_time) AS event_id, 'binance-rest' AS source,
         symbol, '15m' AS interval, open_time, open_time + to_milliseconds(899999) AS close_time,
         v AS open, CASE WHEN n % 20 = 15 THEN v - 1 ELSE v + 0.5::DOUBLE END AS high,
         CASE WHEN n % 20 = 14 THEN NULL ELSE v - 0.5::DOUBLE END AS low, v AS close, volume,
         volume * 2 AS quote_asset_volume, 1::BIGINT AS number_of_trades,
         volume * 0.5::DOUBLE AS taker_buy_base_asset_volume, volume AS taker_buy_quote_asset_volume,
         n % 20 <> 11 AS is_closed, ts AS ingested_at, open_time::DATE AS event_date
  FROM (
    SELECT event_id AS n, upper(event_type) AS symbol, ts,
           CASE WHEN event_id % 20 = 13 THEN -value ELSE value END AS v,
           CASE WHEN event_id % 20 = 16 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS volume,
           make_timestamp((epoch_us(ts) // 900000000) * 900000000) AS open_time
    FROM events
  )
),
usable AS (
  SELECT * FROM versions
  WHERE is_closed AND event_id IS NOT NULL AND symbol IS NOT NULL AND open_time IS NOT NULL
    AND open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low AND high >= open AND high >= close
    AND low <= open AND low <= close AND volume >= 0 AND quote_asset_volume >= 0 AND number_of_trades >= 0
    AND taker_buy_base_asset_volume >= 0 AND taker_buy_quote_asset_volume >= 0
),
silver AS (
  SELECT * FROM usable
  QUALIFY row_number() OVER (PARTITION BY symbol, interval, open_time
                             ORDER BY ingested_at DESC, event_id DESC) = 1
)"""


def event_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One one-minute candle per event, opening at the event's millisecond; prices in whole cents."""
    ts = F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp")))
    cents = F.floor(F.col("value") * 100).cast("double")
    number = F.col("event_id")
    return _candle(
        read(spark, sf_dir, "events"),
        symbol=F.upper("event_type"),
        interval=F.lit("1m"),
        open_time=ts,
        close_time=F.timestamp_millis(F.unix_millis(ts) + 59_999),
        open=cents,
        high=cents + 2,
        low=cents - 2,
        close=cents + 1,
        volume=F.lit(4.0),
        number_of_trades=F.lit(3).cast("bigint"),
        is_closed=number % 20 != 11,
        ingested_at=F.timestamp_millis(F.unix_millis(ts) + 60_000),
    )


EVENT_CANDLES_SQL = """
event_candles AS (
  SELECT 'binance:' || symbol || ':1m:' || epoch_ms(t) AS event_id, 'binance-rest' AS source, symbol,
         '1m' AS interval, t AS open_time, t + to_milliseconds(59999) AS close_time,
         cents AS open, cents + 2 AS high, cents - 2 AS low, cents + 1 AS close, 4.0::DOUBLE AS volume,
         8.0::DOUBLE AS quote_asset_volume, 3::BIGINT AS number_of_trades,
         2.0::DOUBLE AS taker_buy_base_asset_volume, 4.0::DOUBLE AS taker_buy_quote_asset_volume,
         n % 20 <> 11 AS is_closed, t + to_milliseconds(60000) AS ingested_at, n
  FROM (
    SELECT event_id AS n, upper(event_type) AS symbol, floor(value * 100)::DOUBLE AS cents,
           make_timestamp((epoch_us(ts) // 1000) * 1000) AS t
    FROM events
  )
)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON message per event: number, copy, ts, key and payload text, defects included.

    Every tenth event is sent twice.
    """
    number = F.col("event_id")
    events = read(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.upper("event_type").alias("symbol"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("open_ms"),
        F.floor(F.col("value") * 100).cast("bigint").alias("cents"),
    )

    def text(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value.cast("string"))

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    cents, open_ms = F.col("cents"), F.col("open_ms")
    fields = [
        text("event_id", quoted(event_id(F.col("symbol"), F.lit("1m"), open_ms))),
        text("source", F.lit('"binance-rest"')),
        text("symbol", quoted(F.col("symbol"))),
        text("interval", F.lit('"1m"')),
        text("open_time", open_ms),
        text("close_time", open_ms + 59_999),
        text("open", cents),
        text("high", cents + 2),
        text("low", cents - 2),
        F.when(number % 20 == 7, F.lit('"no_close":0')).otherwise(text("close", cents + 1)),
        text("volume", F.lit(4)),
        text("quote_asset_volume", F.lit(8)),
        text("number_of_trades", F.lit(3)),
        text("taker_buy_base_asset_volume", F.lit(2)),
        text("taker_buy_quote_asset_volume", F.lit(4)),
        text("is_closed", number % 20 != 11),
        text("ingested_at", open_ms + 60_000),
    ]
    payload = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    key = partition_key(F.col("symbol"), F.lit("1m"))
    key = (
        F.when(number % 25 == 1, F.lit(None).cast("string"))
        .when(number % 25 == 2, F.lit(""))
        .when(number % 25 == 3, F.col("symbol"))
        .when(number % 25 == 4, F.concat(key, F.lit("|x")))
        .otherwise(key)
    )
    copies = F.when(number % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return events.select(
        F.col("event_id").alias("number"),
        F.explode(copies).alias("copy"),
        "ts",
        key.alias("key"),
        F.when(number % 20 == 3, F.lit("not-avro")).otherwise(payload).alias("payload"),
    )


MESSAGES_SQL = (
    EVENT_CANDLES_SQL
    + """,
messages AS (
  SELECT e.event_id AS number, c.copy, e.ts,
         CASE e.event_id % 25 WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN k.symbol
              WHEN 4 THEN k.symbol || '|1m|x' ELSE k.symbol || '|1m' END AS key,
         CASE WHEN e.event_id % 20 = 3 THEN 'not-avro' ELSE
           '{"event_id":"' || k.event_id || '","source":"binance-rest","symbol":"' || k.symbol
           || '","interval":"1m","open_time":' || epoch_ms(k.open_time)
           || ',"close_time":' || epoch_ms(k.close_time) || ',"open":' || k.open::BIGINT
           || ',"high":' || k.high::BIGINT || ',"low":' || k.low::BIGINT || ','
           || CASE WHEN e.event_id % 20 = 7 THEN '"no_close":0' ELSE '"close":' || k.close::BIGINT END
           || ',"volume":4,"quote_asset_volume":8,"number_of_trades":3,"taker_buy_base_asset_volume":2'
           || ',"taker_buy_quote_asset_volume":4,"is_closed":' || k.is_closed
           || ',"ingested_at":' || epoch_ms(k.ingested_at) || '}' END AS payload,
         e.event_id % 20 NOT IN (3, 7) AS decodable
  FROM events e JOIN event_candles k ON k.n = e.event_id
  JOIN (VALUES (0), (1)) AS c(copy) ON c.copy = 0 OR e.event_id % 10 = 0
)"""
)


def kafka_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages as a Kafka source delivers them, payloads behind a registry header."""
    return messages(spark, sf_dir).select(
        F.col("key").cast("binary").alias("key"),
        F.concat(F.unhex(F.lit("0000000001")), F.encode("payload", "UTF-8")).alias("value"),
        F.lit(TOPIC).alias("topic"),
        (F.col("number") % 3).cast("int").alias("partition"),
        (F.col("number") + F.col("copy") * COPY_OFFSET).alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def kinesis_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).select(
        F.encode("payload", "UTF-8").alias("data"),
        F.col("key").alias("partitionKey"),
        (F.col("number") + F.col("copy") * COPY_OFFSET).cast("string").alias("sequenceNumber"),
        F.col("ts").alias("approximateArrivalTimestamp"),
    )


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One poll per symbol and day at 12:30: the JSON answer with the day's one-hour klines (24 at most)."""
    ms = F.unix_millis
    row = F.array(
        *[
            column.cast("string")
            for column in (
                ms("open_time"),
                F.col("open"),
                F.col("high"),
                F.col("low"),
                F.col("close"),
                F.col("volume"),
                ms("close_time"),
                F.col("quote_asset_volume"),
                F.col("number_of_trades"),
                F.col("taker_buy_base_asset_volume"),
                F.col("taker_buy_quote_asset_volume"),
                F.lit("0"),
            )
        ]
    )
    hourly = bars(spark, sf_dir).filter("interval = '1h'")
    grouped = hourly.groupBy("symbol", "interval", "event_date").agg(
        F.array_sort(F.collect_list(F.struct("open_time", row.alias("row")))).alias("rows")
    )
    noon = F.unix_seconds(F.col("event_date").cast("timestamp")) * 1000 + 45_000_000
    return grouped.select(
        "symbol",
        "interval",
        noon.alias("polled_at_ms"),
        F.to_json(F.transform("rows", lambda item: item["row"])).alias("body"),
    )
