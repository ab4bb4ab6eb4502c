"""Jobs by name: ``spark-submit candlelake/__main__.py JOB --OPTION value ...`` or ``python -m candlelake JOB ...``.

Options may also come from the environment.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

if __name__ == "__main__" and not __package__:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from candlelake.config import JobConfig
from candlelake.plans import jobs
from candlelake.plans.daily import DAILY, run_daily_incremental
from candlelake.plans.incremental import run_gold_incremental, run_silver_incremental
from candlelake.plans.serving import SERVING_TABLES
from candlelake.schema import CANDLE_CONTRACT, KAFKA_RAW_SCHEMA, KINESIS_RAW_SCHEMA
from candlelake.sources.compaction import compact_raw, past_hours
from candlelake.sources.readers import kafka_stream, kinesis_stream
from candlelake.streaming import jobs as streams
from candlelake.streaming.batches import start_bronze_single

Job = Callable[[SparkSession, JobConfig], None]


def contract(spark: SparkSession, config: JobConfig) -> str:
    """The message contract of the file ``CONTRACT_PATH``, read by Spark; ours if none is named."""
    path = config.text("CONTRACT_PATH", "none")
    return CANDLE_CONTRACT if path == "none" else spark.read.text(path, wholetext=True).first()[0]


def raw(spark: SparkSession, config: JobConfig) -> None:
    name = config.text("KINESIS_STREAM_NAME")
    start = config.text("KINESIS_STARTING_POSITION", "TRIM_HORIZON")
    query = streams.start_raw(
        kinesis_stream(spark, name, config.text("AWS_REGION"), start),
        "kinesis",
        config.text("RAW_OUTPUT_PATH"),
        config.text("RAW_CHECKPOINT_PATH"),
        contract=contract(spark, config),
        codec=config.text("CODEC", "avro"),
        stream_name=name,
        trigger_interval=config.text("RAW_TRIGGER_INTERVAL", streams.TRIGGER_INTERVAL),
    )
    query.awaitTermination()


def bronze(spark: SparkSession, config: JobConfig) -> None:
    """Runs until it is stopped; with ``AVAILABLE_NOW true`` until all that is there has been read."""
    once = config.text("AVAILABLE_NOW", "false") == "true"
    queries = streams.start_bronze(
        spark,
        config.text("RAW_INPUT_PATH"),
        KINESIS_RAW_SCHEMA,
        config.text("BRONZE_OUTPUT_PATH"),
        config.text("BRONZE_CHECKPOINT_PATH"),
        rejected_path=config.text("BRONZE_REJECTED_OUTPUT_PATH"),
        rejected_checkpoint_path=config.text("BRONZE_REJECTED_CHECKPOINT_PATH"),
        contract=contract(spark, config),
        codec=config.text("CODEC", "avro"),
        watermark_delay=config.text("BRONZE_WATERMARK_DELAY", streams.WATERMARK_DELAY),
        max_files_per_trigger=config.count("BRONZE_MAX_FILES_PER_TRIGGER", streams.MAX_FILES_PER_TRIGGER),
        trigger_interval=config.text("BRONZE_TRIGGER_INTERVAL", streams.TRIGGER_INTERVAL),
        available_now=once,
    )
    streams.await_all(queries) if once else streams.await_any(spark, queries)


def raw_kafka(spark: SparkSession, config: JobConfig) -> None:
    """A Kafka topic to Raw; runs until it is stopped."""
    topic = kafka_stream(spark, config.text("KAFKA_BOOTSTRAP_SERVERS"), config.text("KAFKA_TOPIC"))
    paths = config.text("RAW_PATH"), config.text("RAW_CHECKPOINT_PATH")
    codec = config.text("CODEC", "avro")
    streams.start_raw(topic, "kafka", *paths, contract=contract(spark, config), codec=codec).awaitTermination()


def bronze_kafka(spark: SparkSession, config: JobConfig) -> None:
    """Kafka's Raw to Bronze, rejected messages to an error topic; payloads behind a registry header."""
    queries = streams.start_bronze(
        spark,
        config.text("RAW_PATH"),
        KAFKA_RAW_SCHEMA,
        config.text("BRONZE_PATH"),
        config.text("BRONZE_CHECKPOINT_PATH"),
        error_topic=(config.text("KAFKA_BOOTSTRAP_SERVERS"), config.text("KAFKA_ERROR_TOPIC")),
        contract=contract(spark, config),
        codec=config.text("CODEC", "avro"),
        confluent_header=True,
        watermark_delay=config.text("BRONZE_WATERMARK_DELAY", streams.WATERMARK_DELAY),
        max_files_per_trigger=None,
        trigger_interval=config.text("BRONZE_TRIGGER_INTERVAL", streams.TRIGGER_INTERVAL),
    )
    streams.await_any(spark, queries)


def bronze_single(spark: SparkSession, config: JobConfig) -> None:
    """As ``bronze``, by one query that reads and decodes Raw once."""
    query = start_bronze_single(
        spark,
        config.text("RAW_INPUT_PATH"),
        KINESIS_RAW_SCHEMA,
        config.text("BRONZE_OUTPUT_PATH"),
        config.text("BRONZE_REJECTED_OUTPUT_PATH"),
        config.text("BRONZE_CHECKPOINT_PATH"),
        contract=contract(spark, config),
        codec=config.text("CODEC", "avro"),
        max_files_per_trigger=config.count("BRONZE_MAX_FILES_PER_TRIGGER", streams.MAX_FILES_PER_TRIGGER),
        trigger_interval=config.text("BRONZE_TRIGGER_INTERVAL", streams.TRIGGER_INTERVAL),
        available_now=config.text("AVAILABLE_NOW", "false") == "true",
    )
    query.awaitTermination()


def compact(spark: SparkSession, config: JobConfig) -> None:
    """Copy the past hours of Raw into few files, up to ``COMPACT_BEFORE`` or the hour before this one."""
    before = config.moment("COMPACT_BEFORE") or past_hours()
    compact_raw(spark, config.text("RAW_INPUT_PATH"), config.text("RAW_COMPACTED_PATH"), KINESIS_RAW_SCHEMA, before)


def replay(spark: SparkSession, config: JobConfig) -> None:
    """Replay days of Raw into a batch Bronze dataset."""
    first, last = (date.fromisoformat(config.text(name)) for name in ("REPLAY_FIRST_DAY", "REPLAY_LAST_DAY"))
    paths = config.text("RAW_INPUT_PATH"), KINESIS_RAW_SCHEMA, config.text("BRONZE_OUTPUT_PATH")
    codec = config.text("CODEC", "avro")
    streams.replay_bronze_days(spark, *paths, first, last, contract=contract(spark, config), codec=codec)


def silver(spark: SparkSession, config: JobConfig) -> None:
    """The whole of Silver, or with ``STATE_PATH`` the days that changed."""
    paths = config.text("BRONZE_INPUT_PATH"), config.text("SILVER_OUTPUT_PATH")
    if config.values.get("STATE_PATH"):
        run_silver_incremental(spark, *paths, config.text("STATE_PATH"))
    else:
        jobs.run_silver(spark, *paths)


def silver_table(spark: SparkSession, config: JobConfig) -> None:
    jobs.run_silver_table(spark, config.text("BRONZE_PATH"), config.text("SILVER_DATABASE"), config.text("SILVER_TABLE"))


def gold(spark: SparkSession, config: JobConfig) -> None:
    """Gold, whole or with ``STATE_PATH`` from the days that changed on, and from it the serving tables.

    With ``STATE_PATH`` the daily summary follows the changed files as well.
    """
    paths = config.text("SILVER_INPUT_PATH"), config.text("GOLD_OUTPUT_PATH")
    base, context = config.text("TRADING_GOLD_OUTPUT_BASE_PATH"), jobs.serving_context(config)
    if config.values.get("STATE_PATH"):
        run_gold_incremental(spark, *paths, config.text("STATE_PATH"))
        jobs.run_serving(spark, paths[1], base, context, [table for table in SERVING_TABLES if table is not DAILY])
        run_daily_incremental(spark, paths[1], base, config.text("STATE_PATH"), context)
    else:
        jobs.run_gold_and_serving(spark, *paths, base, context)


def gold_table(spark: SparkSession, config: JobConfig) -> None:
    silver_name = config.text("SILVER_DATABASE"), config.text("SILVER_TABLE")
    jobs.run_gold_table(spark, silver_name, (config.text("GOLD_DATABASE"), config.text("GOLD_TABLE")))


def batch(spark: SparkSession, config: JobConfig) -> None:
    """From Bronze to the latest-value snapshot, each layer from the stored one before."""
    jobs.run_batch(spark, jobs.BatchConfig.from_options(config))


def datamart(spark: SparkSession, config: JobConfig) -> None:
    jobs.run_datamart(
        spark,
        (config.text("GOLD_DATABASE"), config.text("GOLD_TABLE")),
        jobs.serving_context(config),
        url=config.text("DATAMART_JDBC_URL"),
        user=config.text("DATAMART_USER"),
        password=config.text("DATAMART_PASSWORD"),
        targets=jobs.datamart_targets(config),
    )


def projection(spark: SparkSession, config: JobConfig) -> None:
    paths = config.text("TRADING_GOLD_OUTPUT_BASE_PATH"), config.text("LATEST_SNAPSHOT_PATH")
    moment = config.moment("PROCESSING_TIMESTAMP")
    jobs.run_projection(spark, *paths, now=None if moment is None else F.lit(moment).cast("timestamp"))


STREAMS: tuple[Job, ...] = (raw, raw_kafka, bronze, bronze_kafka, bronze_single)
BATCHES: tuple[Job, ...] = (compact, replay, silver, silver_table, gold, gold_table, datamart, projection, batch)
JOBS: dict[str, Job] = {f.__name__: f for f in STREAMS + BATCHES}


def main(words: list[str]) -> None:
    if not words or words[0] not in JOBS:
        raise SystemExit(f"usage: candlelake {{{'|'.join(JOBS)}}} --OPTION value ...")
    spark = SparkSession.builder.appName(f"candlelake-{words[0]}").getOrCreate()
    JOBS[words[0]](spark, JobConfig.read(words[1:]))


if __name__ == "__main__":
    main(sys.argv[1:])
