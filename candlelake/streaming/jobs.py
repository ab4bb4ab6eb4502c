"""Streaming jobs: broker to Raw, Raw to Bronze, latest-value snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlelake.config import under
from candlelake.functions.codecs import decode_payload
from candlelake.operators.bronze import DEDUP_KEY, build_bronze_final, build_bronze_rejected, build_bronze_valid
from candlelake.operators.envelope import build_raw
from candlelake.operators.scan import first_by
from candlelake.schema import BRONZE_PARTITIONS, BRONZE_SCHEMA, CANDLE_CONTRACT, RAW_PARTITIONS
from candlelake.sources.intermediate import stored
from candlelake.sources.readers import parquet_dataset, parquet_stream
from candlelake.sources.sinks import StreamSink, dataset_exists, write_parquet_dataset

# Cadence of the streaming jobs.
TRIGGER_INTERVAL = "30 seconds"
WATERMARK_DELAY = "2 days"
MAX_FILES_PER_TRIGGER = 100

_REPLAYED = "_replayed"


def start_raw(
    envelope: DataFrame,
    kind: str,
    path: str,
    checkpoint_path: str,
    *,
    contract: str = CANDLE_CONTRACT,
    codec: str = "json",
    confluent_header: bool | None = None,
    stream_name: str | None = None,
    trigger_interval: str | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append a Kafka or Kinesis stream to the Raw dataset."""
    raw = build_raw(
        envelope,
        kind,
        contract=contract,
        codec=codec,
        confluent_header=confluent_header,
        stream_name=stream_name,
    )
    sink = StreamSink.dataset(path, under(checkpoint_path, "global"), RAW_PARTITIONS, f"raw_market_candles_{kind}")
    return sink.start(raw, every=trigger_interval, available_now=available_now)


def start_bronze(
    spark: SparkSession,
    raw_path: str,
    raw_schema: T.StructType,
    bronze_path: str,
    checkpoint_path: str,
    *,
    rejected_path: str | None = None,
    error_topic: tuple[str, str] | None = None,
    rejected_checkpoint_path: str | None = None,
    contract: str = CANDLE_CONTRACT,
    codec: str = "json",
    confluent_header: bool = False,
    watermark_delay: str | None = WATERMARK_DELAY,
    dedup_key: Sequence[str] = DEDUP_KEY,
    spread: int = 8,
    max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    trigger_interval: str | None = TRIGGER_INTERVAL,
    available_now: bool = False,
    trust_flag: bool = True,
    closed_wins: bool = False,
) -> list[StreamingQuery]:
    """Two queries over the Raw dataset: valid candles to Bronze, rejected envelopes to dead letters.

    Dead letters go to a dataset (``rejected_path``) or a topic (``error_topic``, as bootstrap servers
    and name). Each query has its own checkpoint. By the stored flag, what Raw could decode is decoded here once
    more, and the rest is rejected without decoding; Parquet skips what a query does not need. Set ``trust_flag`` to
    False where the contract or codec is not the one that Raw was written with. With ``closed_wins`` an event is written
    when the watermark has passed it, in its closed version if there was one (``build_bronze_final``).
    """
    if (rejected_path is None) == (error_topic is None):
        raise ValueError("give either rejected_path or error_topic")
    raw = parquet_stream(spark, raw_path, raw_schema, max_files_per_trigger)
    sound, broken = _by_flag(raw, trust_flag)
    decoded = decode_payload(sound, contract, codec=codec, confluent_header=confluent_header)
    if closed_wins:
        valid = build_bronze_final(decoded, watermark_delay=watermark_delay, dedup_key=dedup_key)
    else:
        valid = build_bronze_valid(decoded, watermark_delay=watermark_delay, dedup_key=dedup_key, spread=spread)
    if not trust_flag:
        broken = decode_payload(broken, contract, codec=codec, confluent_header=confluent_header)
    letters = rejected_checkpoint_path or f"{checkpoint_path.rstrip('/')}_errors"
    name = "bronze_market_candles"
    dead = (
        StreamSink.topic(*error_topic, letters, f"{name}_errors")
        if error_topic
        else StreamSink.dataset(rejected_path, letters, (), f"{name}_rejected")
    )
    bronze = StreamSink.dataset(bronze_path, checkpoint_path, BRONZE_PARTITIONS, name)
    streams = ((bronze, valid), (dead, build_bronze_rejected(broken)))
    return [sink.start(rows, every=trigger_interval, available_now=available_now) for sink, rows in streams]


def _by_flag(raw: DataFrame, trust_flag: bool) -> tuple[DataFrame, DataFrame]:
    """Raw records that Raw could decode, and the others with an empty ``data``; all for both without the flag."""
    if not trust_flag:
        return raw, raw
    decodable = F.coalesce("is_avro_decodable", F.lit(False))
    return raw.filter(decodable), raw.filter(~decodable).withColumn("data", F.lit(None).cast("string"))


def await_any(spark: SparkSession, queries: Sequence[StreamingQuery]) -> None:
    """Wait until one of the queries ends, then stop all of them."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in queries:
            query.stop()


def await_all(queries: Sequence[StreamingQuery]) -> None:
    """Wait for queries that end by themselves; the failure of one is raised after all have stopped."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            query.stop()


def replay_bronze(
    spark: SparkSession,
    raw_path: str,
    raw_schema: T.StructType,
    *,
    contract: str = CANDLE_CONTRACT,
    codec: str = "json",
    confluent_header: bool = False,
    trust_flag: bool = True,
    rows: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected records of the whole Raw dataset, or of its ``rows``, as a batch; nothing is late in a batch."""
    raw = parquet_dataset(spark, raw_path, raw_schema)
    sound, broken = _by_flag(raw if rows is None else raw.where(rows), trust_flag)
    decoded = decode_payload(sound, contract, codec=codec, confluent_header=confluent_header)
    if not trust_flag:
        broken = decoded
    return build_bronze_valid(decoded), build_bronze_rejected(broken)


def replay_bronze_days(
    spark: SparkSession, raw_path: str, raw_schema: T.StructType, bronze_path: str, first: date, last: date, **options
) -> int:
    """Replay the Raw days ``first`` to ``last`` (of ingestion) into a stored Bronze dataset; the partitions rewritten.

    Of each event the version ingested first stays, of those stored and those replayed, as a full replay has it. Only
    partitions with rows that the stored ones lack are written again. For ``options`` see ``replay_bronze``. A Bronze
    folder that a stream owns has a log that names its files and is refused.
    """
    if dataset_exists(spark, under(bronze_path, "_spark_metadata")):
        raise ValueError(f"{bronze_path} belongs to a stream; replay into a dataset of its own")
    days = (F.col("ingestion_date") >= F.lit(first)) & (F.col("ingestion_date") <= F.lit(last))
    replayed = stored(replay_bronze(spark, raw_path, raw_schema, rows=days, **options)[0])
    columns = BRONZE_SCHEMA.fieldNames()
    fresh = replayed.select(*columns, F.lit(1).alias(_REPLAYED))
    if dataset_exists(spark, bronze_path):
        known = parquet_dataset(spark, bronze_path, BRONZE_SCHEMA)
        touched = replayed.select(*BRONZE_PARTITIONS).distinct()
        # Partitions are found by the columns of their folders, so no others are read.
        near = known.join(touched, list(BRONZE_PARTITIONS), "left_semi").select(*columns, F.lit(0).alias(_REPLAYED))
        merged = stored(first_by(near.unionByName(fresh), DEDUP_KEY, [F.col("ingested_at"), F.col(_REPLAYED)]))
        changed = merged.where(F.col(_REPLAYED) == 1).select(*BRONZE_PARTITIONS).distinct()
        fresh = merged.join(changed, list(BRONZE_PARTITIONS), "left_semi")
    n = fresh.select(*BRONZE_PARTITIONS).distinct().count()
    if n:
        write_parquet_dataset(fresh.drop(_REPLAYED), bronze_path, BRONZE_PARTITIONS, dynamic=True)
    return n


def recent_late_rows(query: StreamingQuery) -> int:
    """Rows dropped for being later than the watermark, in the batches whose progress Spark still keeps."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def state_rows(query: StreamingQuery) -> int:
    """Rows in the state of a query after its last batch."""
    progress = query.lastProgress
    return 0 if progress is None else sum(op["numRowsTotal"] for op in progress["stateOperators"])
