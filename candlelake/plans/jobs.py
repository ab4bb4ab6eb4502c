"""Batch jobs: Silver, Gold, serving tables, and the run of all of them in order."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.config import JobConfig, under
from candlelake.operators.chunks import Chunks, measured_chunks
from candlelake.operators.indicators import calculate_indicators
from candlelake.operators.scan import ChunkLength
from candlelake.operators.silver import build_silver
from candlelake.plans.restitution import latest_snapshot, merge_snapshot
from candlelake.plans.serving import SERVING_TABLES, ServingContext, ServingTable, materialize_serving_tables
from candlelake.schema import (
    BRONZE_SCHEMA,
    GOLD_PARTITIONS,
    GOLD_SCHEMA,
    GOLD_SOURCE_COLUMNS,
    SERIES_KEY,
    SERIES_ORDER,
    SILVER_PARTITIONS,
    SILVER_SCHEMA,
    project,
)
from candlelake.sources.readers import catalog_table, parquet_dataset
from candlelake.sources.sinks import dataset_exists, replace_parquet_dataset, write_jdbc_table, write_table


def build_gold(silver: DataFrame, chunk_seconds: ChunkLength = None) -> DataFrame:
    """Candles with their indicators and calendar day."""
    candles = project(silver, GOLD_SOURCE_COLUMNS)
    return calculate_indicators(candles, chunk_seconds).withColumn("event_date", F.to_date("open_time"))


def gold_chunks(silver: DataFrame) -> Chunks:
    """Chunks of stored candles that no burst overfills."""
    return measured_chunks(silver, SERIES_KEY, SERIES_ORDER[0])


def run_silver(spark: SparkSession, bronze_path: str, silver_path: str) -> None:
    silver = build_silver(parquet_dataset(spark, bronze_path, BRONZE_SCHEMA))
    replace_parquet_dataset(silver, silver_path, SILVER_PARTITIONS)


def run_silver_table(spark: SparkSession, bronze_path: str, database: str, table: str) -> None:
    silver = build_silver(parquet_dataset(spark, bronze_path, BRONZE_SCHEMA))
    write_table(silver, database, table, SILVER_PARTITIONS)


def run_gold(spark: SparkSession, silver_path: str, gold_path: str) -> None:
    """Indicators of the stored Silver dataset, in chunks that hold as many rows as a task should see."""
    silver = parquet_dataset(spark, silver_path, SILVER_SCHEMA)
    replace_parquet_dataset(build_gold(silver, gold_chunks(silver)), gold_path, GOLD_PARTITIONS)


def run_gold_table(
    spark: SparkSession, silver: tuple[str, str], gold: tuple[str, str]
) -> None:
    """Gold from and to catalog tables, each given as database and table; chunks as in ``run_gold``."""
    candles = catalog_table(spark, *silver)
    write_table(build_gold(candles, gold_chunks(candles)), *gold, GOLD_PARTITIONS)


def run_serving(
    spark: SparkSession,
    gold_path: str,
    output_base_path: str,
    context: ServingContext,
    tables: Iterable[ServingTable] = SERVING_TABLES,
) -> None:
    """Serving tables from the stored Gold dataset, which all of them scan instead of recomputing it."""
    gold, context = parquet_dataset(spark, gold_path, GOLD_SCHEMA), replace(context, measured=True)
    for table, frame in materialize_serving_tables(gold, context, tables):
        replace_parquet_dataset(frame, under(output_base_path, table.name), table.partition_columns)


def run_gold_and_serving(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    output_base_path: str,
    context: ServingContext,
) -> None:
    run_gold(spark, silver_path, gold_path)
    run_serving(spark, gold_path, output_base_path, context)


def run_datamart(
    spark: SparkSession,
    gold: tuple[str, str],
    context: ServingContext,
    *,
    url: str,
    user: str,
    password: str,
    targets: Mapping[str, str],
    **jdbc,
) -> None:
    """Serving tables from a Gold table to a database; ``targets`` maps table names to target names."""
    for table, frame in materialize_serving_tables(catalog_table(spark, *gold), replace(context, measured=True)):
        write_jdbc_table(frame, url, targets[table.name], user, password, table.mode, **jdbc)


def datamart_targets(config: JobConfig) -> dict[str, str]:
    return {table.name: config.text(table.target_option) for table in SERVING_TABLES}


def run_projection(
    spark: SparkSession, serving_base_path: str, snapshot_path: str, *, now: Column | None = None
) -> None:
    """Put the latest serving table into the stored snapshot: its series replace their entries, others stay until
    they expire. The new snapshot takes the old one's place when it is complete."""
    latest = parquet_dataset(spark, under(serving_base_path, "market_indicators_latest"))
    snapshot = latest_snapshot(latest, now=now)
    if dataset_exists(spark, snapshot_path):
        snapshot = merge_snapshot(parquet_dataset(spark, snapshot_path, snapshot.schema), snapshot, now=now)
    replace_parquet_dataset(snapshot, snapshot_path)


@dataclass(frozen=True)
class BatchPaths:
    bronze: str
    silver: str
    gold: str
    serving: str
    snapshot: str


@dataclass(frozen=True)
class BatchConfig:
    paths: BatchPaths
    context: ServingContext = field(default_factory=ServingContext)

    @classmethod
    def from_options(cls, config: JobConfig) -> BatchConfig:
        return cls(
            BatchPaths(
                bronze=config.text("BRONZE_OUTPUT_PATH"),
                silver=config.text("SILVER_OUTPUT_PATH"),
                gold=config.text("GOLD_OUTPUT_PATH"),
                serving=config.text("TRADING_GOLD_OUTPUT_BASE_PATH"),
                snapshot=config.text("LATEST_SNAPSHOT_PATH"),
            ),
            serving_context(config),
        )


def serving_context(config: JobConfig) -> ServingContext:
    return ServingContext(
        base_interval=config.text("DATAMART_BASE_INTERVAL", "1m"),
        context_intervals=tuple(config.items("DATAMART_CONTEXT_INTERVALS", "15m,1h")),
        processing_timestamp=config.moment("PROCESSING_TIMESTAMP"),
    )


def run_batch(spark: SparkSession, config: BatchConfig) -> None:
    """Bronze to Silver to Gold to serving tables to latest-value snapshot, each from the stored layer before."""
    paths = config.paths
    run_silver(spark, paths.bronze, paths.silver)
    run_gold_and_serving(spark, paths.silver, paths.gold, paths.serving, config.context)
    now = None if config.context.processing_timestamp is None else config.context.processed_at()
    run_projection(spark, paths.serving, paths.snapshot, now=now)
