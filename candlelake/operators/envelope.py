"""Raw layer: broker envelopes to Raw records, and candles to broker messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.functions.candles import key_part, partition_key
from candlelake.functions.codecs import decode_payload, encode_payload
from candlelake.operators.bronze import DEDUP_KEY, deduplicate
from candlelake.schema import CANDLE_CONTRACT, KAFKA_RAW_SCHEMA, KINESIS_RAW_SCHEMA


def stamp_ingestion(frame: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Add ingestion time, date and hour; the time is that of the (micro-)batch unless given."""
    stamped = frame.withColumn(
        "ingested_at", F.current_timestamp() if ingested_at is None else ingested_at
    )
    return stamped.withColumns(
        {"ingestion_date": F.to_date("ingested_at"), "ingestion_hour": F.hour("ingested_at")}
    )


def build_raw(
    envelope: DataFrame,
    kind: str,
    *,
    contract: str = CANDLE_CONTRACT,
    codec: str = "json",
    confluent_header: bool | None = None,
    stream_name: str | None = None,
    ingested_at: Column | None = None,
    record_column: str | None = None,
) -> DataFrame:
    """Raw records of a Kafka or Kinesis envelope stream: metadata, untouched payload, key parts.

    The payload is decoded to flag whether it can be; ``record_column`` keeps the decoded record as well, so that
    Bronze in the same plan need not decode again. Kafka payloads carry a registry header unless stated otherwise.
    """
    if kind == "kafka":
        source = envelope.withColumn("key", F.col("key").cast("string"))
        columns = [
            F.lit("kafka").alias("source"),
            F.col("topic"),
            F.col("partition"),
            F.col("offset"),
            F.col("key"),
            F.col("value"),
            F.col("timestamp").alias("kafka_timestamp"),
            F.col("timestampType").alias("kafka_timestamp_type"),
        ]
        key, schema = "key", KAFKA_RAW_SCHEMA
    elif kind == "kinesis":
        if not stream_name:
            raise ValueError("stream_name is required for kinesis envelopes")
        source = envelope.withColumnRenamed("data", "value")
        columns = [
            F.lit("kinesis").alias("source"),
            F.lit(stream_name).alias("stream_name"),
            F.col("partitionKey").alias("partition_key"),
            F.col("sequenceNumber").alias("sequence_number"),
            F.col("approximateArrivalTimestamp").alias("approximate_arrival_timestamp"),
            F.col("value"),
            F.length("value").alias("payload_size_bytes"),
        ]
        key, schema = "partitionKey", KINESIS_RAW_SCHEMA
    else:
        raise ValueError(f"unknown envelope kind: {kind}")

    decoded = decode_payload(
        source,
        contract,
        output_column="_decoded",
        codec=codec,
        confluent_header=kind == "kafka" if confluent_header is None else confluent_header,
    )
    raw = decoded.select(
        *columns,
        key_part(key, 0).alias("symbol"),
        key_part(key, 1).alias("interval"),
        F.col("_decoded").isNotNull().alias("is_avro_decodable"),
        *([F.col("_decoded").alias(record_column)] if record_column else []),
    )
    return stamp_ingestion(raw, ingested_at).select(*schema.fieldNames(), *([record_column] if record_column else []))


def candle_messages(
    candles: DataFrame,
    *,
    contract: str = CANDLE_CONTRACT,
    codec: str = "json",
    schema_id: int | None = None,
    distinct_events: bool = True,
    watermark_delay: str | None = None,
) -> DataFrame:
    """``(key, value)`` messages of candles, at most one per event: in a batch the one ingested first.

    A stream of candles needs ``watermark_delay``: by the watermark, Spark forgets events that are long past.
    """
    unique = candles
    if distinct_events:
        if candles.isStreaming and watermark_delay is None:
            raise ValueError("a stream of distinct events needs watermark_delay")
        bounded = candles.withWatermark("open_time", watermark_delay) if candles.isStreaming else candles
        unique = deduplicate(bounded, DEDUP_KEY)
    return encode_payload(unique, contract, codec=codec, schema_id=schema_id).select(
        partition_key().alias("key"), "value"
    )
