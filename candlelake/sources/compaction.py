"""Compaction of the Raw dataset: the many small files of past hours in few.

A stream writes a file per trigger into every partition. Its folder belongs to the stream (the log beside the files says
which count), so files are not exchanged there. Past hours are copied into a dataset of their own, with files of the
advisory size, and a mark beside it says up to which hour they have been copied. The mark is replaced in one rename when the
copy is complete, and readers take older hours from the copy and the rest from the stream's folder: none sees an hour half
done, twice or not at all. Files of copied hours can then be removed by age.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.schema import RAW_PARTITIONS
from candlelake.sources.readers import parquet_dataset
from candlelake.sources.sinks import dataset_exists, dataset_mark, replace_mark, write_parquet_dataset

UNTIL = "_compacted_until"
_FORMAT = "%Y-%m-%d %H"


def _hour_before(until: str) -> Column:
    """Rows of hours before; by the partition columns, so that other hours are not listed or read."""
    day, hour = until.split(" ")
    date, number = F.lit(day).cast("date"), int(hour)
    return (F.col("ingestion_date") < date) | ((F.col("ingestion_date") == date) & (F.col("ingestion_hour") < number))


def compacted_until(spark: SparkSession, compacted_path: str) -> str | None:
    """The first hour that has not been copied, as ``YYYY-MM-DD HH``; None before the first compaction."""
    return dataset_mark(spark, compacted_path, UNTIL) if dataset_exists(spark, compacted_path) else None


def compact_raw(spark: SparkSession, raw_path: str, compacted_path: str, raw_schema: T.StructType, before: datetime) -> str:
    """Copy the hours that are over by ``before`` and have not been copied; the first hour that is left.

    Choose ``before`` so that the stream writes no more rows of earlier hours: an hour after a row's ingestion is ample. A
    copy that failed is done again, over what it has left.
    """
    moment = before.astimezone(UTC) if before.tzinfo else before.replace(tzinfo=UTC)
    until = moment.strftime(_FORMAT)
    done = compacted_until(spark, compacted_path)
    if done is not None and done >= until:
        return done
    fresh = parquet_dataset(spark, raw_path, raw_schema).where(_hour_before(until))
    if done is not None:
        fresh = fresh.where(~_hour_before(done))
    write_parquet_dataset(fresh, compacted_path, RAW_PARTITIONS, dynamic=True)
    replace_mark(spark, compacted_path, UNTIL, until)
    return until


def raw_dataset(spark: SparkSession, raw_path: str, compacted_path: str, raw_schema: T.StructType) -> DataFrame:
    """All of Raw: copied hours from the copy, later ones from the stream's folder."""
    live, until = parquet_dataset(spark, raw_path, raw_schema), compacted_until(spark, compacted_path)
    if until is None:
        return live
    copied = parquet_dataset(spark, compacted_path, raw_schema).where(_hour_before(until))
    columns = raw_schema.fieldNames()
    return copied.select(*columns).unionByName(live.where(~_hour_before(until)).select(*columns))


def past_hours(hours: int = 1) -> datetime:
    """The start of the hour so many hours ago: a safe ``before``."""
    return datetime.now(UTC).replace(minute=0, second=0, microsecond=0) - timedelta(hours=hours)
