"""Silver and Gold kept up to date by the partitions whose files have changed.

A run compares the files of each input partition (day and series) with those that the run before has stored, which reads
names, sizes and times of files and no data. A day of Silver follows from the same day of Bronze alone. An indicator
follows from all candles before it, but of those it needs only the summary of each chunk: these are stored, so a changed
day is computed from the start of its chunk on, and Gold is written from that day on. What changed is marked as done
last; a run that fails is repeated by the next one, with the same result.

Chunks are those of the interval label here: chunks by count would shift with a late row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.config import under
from candlelake.operators.indicators import indicator_blocks, indicator_states, with_indicators
from candlelake.operators.scan import CHUNK, PART, default_chunk_seconds, time_chunk
from candlelake.operators.silver import build_silver
from candlelake.schema import (
    BRONZE_SCHEMA,
    GOLD_COLUMNS,
    GOLD_PARTITIONS,
    GOLD_SOURCE_COLUMNS,
    SERIES_KEY,
    SILVER_PARTITIONS,
    SILVER_SCHEMA,
    project,
)
from candlelake.sources.intermediate import stored
from candlelake.sources.readers import parquet_dataset
from candlelake.sources.sinks import dataset_exists, drop_partitions, replace_parquet_dataset, write_parquet_dataset

MARK, OLD_MARK = "_mark", "_old_mark"
_FIRST_DAY, _FIRST_CHUNK = "_first_day", "_first_chunk"


@dataclass(frozen=True)
class Rebuilt:
    """What a run did: whether it computed everything, and how many partitions it found changed and removed."""

    whole: bool
    changed: int
    removed: int = 0


def partition_marks(spark: SparkSession, path: str, schema: T.StructType, partitions: tuple[str, ...]) -> DataFrame:
    """A row for each partition that has files, with a mark that changes when one of them comes, goes or is rewritten."""
    files = parquet_dataset(spark, path, schema).select(
        *partitions, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("time"),
    )
    # The file's columns are constant within a file, so each task reduces its rows to its files.
    return files.distinct().groupBy(*partitions).agg(F.sum(F.xxhash64("file", "size", "time").cast("decimal(38,0)")).alias(MARK))


def changed_partitions(now: DataFrame, then: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """Partitions whose marks differ, with both marks; ``_mark`` is NULL where a partition has no files any more."""
    same = F.lit(True)
    for name in partitions:
        same = same & F.col(f"n.{name}").eqNullSafe(F.col(f"t.{name}"))
    joined = now.alias("n").join(then.alias("t"), same, "full")
    keys = [F.coalesce(f"n.{name}", f"t.{name}").alias(name) for name in partitions]
    found = joined.select(*keys, F.col(f"n.{MARK}").alias(MARK), F.col(f"t.{MARK}").alias(OLD_MARK))
    return found.where(~F.col(MARK).eqNullSafe(F.col(OLD_MARK)))


def _of(frame: DataFrame, partitions: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Rows of the given partitions; the join on partition columns prunes the scan."""
    return frame.join(partitions.select(*names).distinct(), list(names), "left_semi")


def run_silver_incremental(spark: SparkSession, bronze_path: str, silver_path: str, state_path: str) -> Rebuilt:
    """Silver of the partitions of Bronze that have changed since the last run, in place of their old rows.

    The first run, or one without a Silver dataset, builds all.
    """
    marks_path = under(state_path, "bronze_marks")
    marks = stored(partition_marks(spark, bronze_path, BRONZE_SCHEMA, SILVER_PARTITIONS))
    bronze = parquet_dataset(spark, bronze_path, BRONZE_SCHEMA)
    if not (dataset_exists(spark, marks_path) and dataset_exists(spark, silver_path)):
        replace_parquet_dataset(build_silver(bronze), silver_path, SILVER_PARTITIONS)
        replace_parquet_dataset(marks, marks_path)
        return Rebuilt(True, marks.count())
    changed = stored(changed_partitions(marks, parquet_dataset(spark, marks_path, marks.schema), SILVER_PARTITIONS))
    n = changed.count()
    if not n:
        return Rebuilt(False, 0)
    silver = stored(build_silver(_of(bronze, changed, SILVER_PARTITIONS)))
    write_parquet_dataset(silver, silver_path, SILVER_PARTITIONS, dynamic=True)
    # Days that came out empty: their rows are all gone or no longer pass the rules.
    empty = changed.select(*SILVER_PARTITIONS).join(silver.select(*SILVER_PARTITIONS).distinct(), list(SILVER_PARTITIONS), "left_anti")
    removed = drop_partitions(spark, silver_path, empty)
    replace_parquet_dataset(marks, marks_path)
    return Rebuilt(False, n, removed)


def run_gold_incremental(spark: SparkSession, silver_path: str, gold_path: str, state_path: str) -> Rebuilt:
    """Gold from the first changed day of each series on; earlier days and other series keep their files.

    The first run, or one without a Gold dataset, builds all. The state has one row per chunk of a series.
    """
    marks_path, chunks_path = under(state_path, "silver_marks"), under(state_path, "chunks")
    marks = stored(partition_marks(spark, silver_path, SILVER_SCHEMA, GOLD_PARTITIONS))
    silver = parquet_dataset(spark, silver_path, SILVER_SCHEMA)
    if not all(dataset_exists(spark, path) for path in (marks_path, chunks_path, gold_path)):
        candles = project(silver, GOLD_SOURCE_COLUMNS)
        blocks = stored(indicator_blocks(candles))
        gold = with_indicators(candles, blocks=blocks).select(*GOLD_COLUMNS, F.to_date("open_time").alias("event_date"))
        replace_parquet_dataset(gold, gold_path, GOLD_PARTITIONS)
        replace_parquet_dataset(indicator_states(blocks), chunks_path)
        replace_parquet_dataset(marks, marks_path)
        return Rebuilt(True, marks.count())
    changed = stored(changed_partitions(marks, parquet_dataset(spark, marks_path, marks.schema), GOLD_PARTITIONS))
    n = changed.count()
    if not n:
        return Rebuilt(False, 0)
    seconds = default_chunk_seconds(SERIES_KEY)
    first = changed.groupBy(*SERIES_KEY).agg(F.min("event_date").alias(_FIRST_DAY))
    first = stored(first.withColumn(_FIRST_CHUNK, time_chunk(F.col(_FIRST_DAY).cast("timestamp"), seconds)))
    start = F.to_date(F.timestamp_seconds(F.col(_FIRST_CHUNK) * seconds))
    earliest = first.agg(F.min(start)).first()[0]
    # A day earlier, for sessions in other zones; the day of each series then decides by row.
    recent = silver.where(F.col("event_date") >= F.date_sub(F.lit(earliest), 1)).join(first, list(SERIES_KEY))
    candles = project(recent, [*GOLD_SOURCE_COLUMNS, _FIRST_DAY]).where(time_chunk("open_time", seconds) >= recent[_FIRST_CHUNK])
    states = spark.read.parquet(chunks_path)
    known = states.join(first, list(SERIES_KEY), "left")
    earlier = known.where(F.col(CHUNK) < F.col(_FIRST_CHUNK)).select(*states.columns)
    blocks = stored(indicator_blocks(candles))
    gold = with_indicators(candles, blocks=blocks, before=earlier).select(*GOLD_COLUMNS, F.to_date("open_time").alias("event_date"), _FIRST_DAY)
    following = gold.where(F.col("event_date") >= F.col(_FIRST_DAY)).drop(_FIRST_DAY)
    write_parquet_dataset(following, gold_path, GOLD_PARTITIONS, dynamic=True)
    removed = drop_partitions(spark, gold_path, changed.where(F.col(MARK).isNull()).select(*GOLD_PARTITIONS))
    others = known.where(F.col(_FIRST_CHUNK).isNull() | (F.col(CHUNK) < F.col(_FIRST_CHUNK))).select(*states.columns)
    fresh = indicator_states(blocks).select(*SERIES_KEY, CHUNK, F.col(PART).cast(states.schema[PART].dataType).alias(PART))
    replace_parquet_dataset(others.unionByName(fresh), chunks_path)
    replace_parquet_dataset(marks, marks_path)
    return Rebuilt(False, n, removed)
