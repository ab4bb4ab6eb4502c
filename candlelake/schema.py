"""Data contract, layer schemas and layer column lists."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The candle contract (field names, order and wire types).
CANDLE_CONTRACT = """{
  "type": "record",
  "name": "MarketCandle",
  "namespace": "candlelake.v1",
  "fields": [
    {"name": "event_id", "type": "string"},
    {"name": "source", "type": "string"},
    {"name": "symbol", "type": "string"},
    {"name": "interval", "type": "string"},
    {"name": "open_time", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    {"name": "close_time", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    {"name": "open", "type": "double"},
    {"name": "high", "type": "double"},
    {"name": "low", "type": "double"},
    {"name": "close", "type": "double"},
    {"name": "volume", "type": "double"},
    {"name": "quote_asset_volume", "type": "double"},
    {"name": "number_of_trades", "type": "long"},
    {"name": "taker_buy_base_asset_volume", "type": "double"},
    {"name": "taker_buy_quote_asset_volume", "type": "double"},
    {"name": "is_closed", "type": "boolean"},
    {"name": "ingested_at", "type": {"type": "long", "logicalType": "timestamp-millis"}}
  ]
}"""

_SPARK_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def read_contract(path: str) -> str:
    """Contract text from a driver-local file (a job parameter, a few hundred bytes)."""
    return Path(path).read_text(encoding="utf-8")


def contract_fields(contract: str) -> list[tuple[str, str, bool]]:
    """``(name, kind, nullable)`` per contract field, in wire order.

    ``kind`` is one of string, long, double, boolean and timestamp-millis. A field may be a union of
    null and one of these, written null first, which is how the contract evolves.
    """
    record = json.loads(contract)
    if record.get("type") != "record":
        raise ValueError("contract must be a record")
    fields = []
    for field in record["fields"]:
        declared, nullable = field["type"], False
        if isinstance(declared, list):
            if len(declared) != 2 or declared[0] != "null":
                raise ValueError(f"unsupported union for contract field {field['name']}")
            declared, nullable = declared[1], True
        kind = declared
        if isinstance(declared, dict):
            kind = declared.get("logicalType", declared["type"])
        if kind != "timestamp-millis" and kind not in _SPARK_TYPES:
            raise ValueError(f"unsupported type for contract field {field['name']}: {declared}")
        fields.append((field["name"], kind, nullable))
    return fields


def contract_defaults(contract: str) -> dict[str, object]:
    """The fields that have a default other than null, with it: what a record of an earlier version is read with."""
    return {field["name"]: field["default"] for field in json.loads(contract)["fields"] if field.get("default") is not None}


def contract_schema(contract: str = CANDLE_CONTRACT) -> T.StructType:
    """Typed schema of a decoded message. Every field is nullable: decoding never asserts presence."""
    return T.StructType(
        [
            T.StructField(name, _SPARK_TYPES.get(kind, T.TimestampType()))
            for name, kind, _ in contract_fields(contract)
        ]
    )


def wire_schema(contract: str = CANDLE_CONTRACT) -> T.StructType:
    """Schema as it travels: timestamps are epoch milliseconds."""
    return T.StructType(
        [
            T.StructField(name, _SPARK_TYPES.get(kind, T.LongType()))
            for name, kind, _ in contract_fields(contract)
        ]
    )


CANDLE_SCHEMA = contract_schema()
CANDLE_COLUMNS = CANDLE_SCHEMA.fieldNames()

# The message key, the Raw layouts of both brokers, and the envelope columns kept with rejects.
KEY_SEPARATOR = "|"
UNKNOWN_KEY_PART = "_unknown"

_INGESTION = [
    T.StructField("ingestion_date", T.DateType()),
    T.StructField("ingestion_hour", T.IntegerType()),
]

KAFKA_RAW_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("kafka_timestamp", T.TimestampType()),
        T.StructField("kafka_timestamp_type", T.IntegerType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("is_avro_decodable", T.BooleanType()),
        *_INGESTION,
    ]
)

KINESIS_RAW_SCHEMA = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("stream_name", T.StringType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("sequence_number", T.StringType()),
        T.StructField("approximate_arrival_timestamp", T.TimestampType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("payload_size_bytes", T.IntegerType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("is_avro_decodable", T.BooleanType()),
        T.StructField("ingested_at", T.TimestampType()),
        *_INGESTION,
    ]
)

# Envelope columns a rejected record keeps, in output order.
ENVELOPE_COLUMNS = [
    "source",
    "topic",
    "partition",
    "offset",
    "stream_name",
    "partition_key",
    "sequence_number",
    "key",
    "value",
    "kafka_timestamp",
    "kafka_timestamp_type",
    "approximate_arrival_timestamp",
    "ingested_at",
    "symbol",
    "interval",
    "ingestion_date",
    "ingestion_hour",
    "is_avro_decodable",
]

BRONZE_COLUMNS = [*CANDLE_COLUMNS, "event_date", "year", "month", "day"]
SILVER_COLUMNS = [*CANDLE_COLUMNS, "event_date"]

# The columns that Gold reads and adds, and the partitions of each layer.
GOLD_SOURCE_COLUMNS = [
    "symbol",
    "interval",
    "open_time",
    "close_time",
    "open",
    "high",
    "low",
    "close",
    "volume",
]
INDICATOR_COLUMNS = [
    "ema_12",
    "ema_26",
    "macd",
    "rsi_14",
    "bollinger_middle",
    "bollinger_upper",
    "bollinger_lower",
]
GOLD_COLUMNS = [*GOLD_SOURCE_COLUMNS, *INDICATOR_COLUMNS]

RAW_PARTITIONS = ("symbol", "interval", "ingestion_date", "ingestion_hour")
BRONZE_PARTITIONS = ("event_date", "symbol", "interval")
SILVER_PARTITIONS = ("event_date", "symbol", "interval")
GOLD_PARTITIONS = ("event_date", "symbol", "interval")

SERIES_KEY = ("symbol", "interval")
SERIES_ORDER = ("open_time", "close_time")

SILVER_SCHEMA = T.StructType([*CANDLE_SCHEMA.fields, T.StructField("event_date", T.DateType())])
BRONZE_SCHEMA = T.StructType(
    [
        *SILVER_SCHEMA.fields,
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
    ]
)
GOLD_SCHEMA = T.StructType(
    [
        *[CANDLE_SCHEMA[name] for name in GOLD_SOURCE_COLUMNS],
        *[T.StructField(name, T.DoubleType()) for name in INDICATOR_COLUMNS],
        T.StructField("event_date", T.DateType()),
    ]
)


def project(frame: DataFrame, columns: list[str]) -> DataFrame:
    """Exact ordered projection onto a layer's columns; a missing column is an error at plan time."""
    missing = [name for name in columns if name not in frame.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return frame.select(*columns)
