"""Batch and streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def kafka_options(bootstrap_servers: str, topic: str, **options: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **options,
    }


def kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str, **options: str) -> DataFrame:
    """One topic from its beginning; needs Spark's Kafka connector. ``maxOffsetsPerTrigger`` limits the rate."""
    reader = spark.readStream.format("kafka")
    return reader.options(**kafka_options(bootstrap_servers, topic, **options)).load()


def kinesis_options(
    stream_name: str, region: str, starting_position: str = "TRIM_HORIZON", **options: str
) -> dict[str, str]:
    return {
        "streamName": stream_name,
        "region": region,
        "startingPosition": starting_position,
        **options,
    }


def kinesis_stream(spark: SparkSession, stream_name: str, region: str, **options: str) -> DataFrame:
    """One Kinesis stream; needs a connector that registers the ``kinesis`` format."""
    reader = spark.readStream.format("kinesis")
    return reader.options(**kinesis_options(stream_name, region, **options)).load()


def parquet_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Files of a dataset as they arrive; partition directories become columns of the given types."""
    reader = spark.readStream.schema(schema).option("basePath", path)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def parquet_dataset(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A whole dataset. With a schema no file is opened to infer one, and partition values keep their type."""
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def catalog_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.read.table(f"`{database}`.`{table}`")


def kline_polls(spark: SparkSession, path: str) -> DataFrame:
    """Landed REST answers: JSON lines of symbol, interval, polled_at_ms and the answer's text as body."""
    schema = "symbol string, interval string, polled_at_ms bigint, body string"
    return spark.read.schema(schema).json(path)
