"""Streams whose micro-batches are written by a function, so that a repeated batch leaves the outputs as they were.

Spark may run a batch again after a failure, under the same id. A batch of rows therefore goes to a folder of its own,
which a repetition overwrites; a batch that is merged into a dataset leaves its id with the dataset, in the same rename.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from candlelake.functions.codecs import decode_payload
from candlelake.operators.bronze import DEDUP_KEY, build_bronze_rejected, build_bronze_valid
from candlelake.operators.scan import first_by
from candlelake.plans.restitution import latest_snapshot
from candlelake.plans.serving import ServingContext, market_indicators_latest
from candlelake.schema import BRONZE_PARTITIONS, BRONZE_SCHEMA, CANDLE_CONTRACT, SERIES_KEY
from candlelake.sources.readers import parquet_dataset, parquet_stream
from candlelake.sources.sinks import dataset_exists, dataset_mark, replace_parquet_dataset, write_parquet_dataset
from candlelake.streaming.jobs import MAX_FILES_PER_TRIGGER, TRIGGER_INTERVAL

BATCH = "batch"
MERGED = "_merged_batch"

BatchWriter = Callable[[DataFrame, int], None]


def start_batches(
    frame: DataFrame, write: BatchWriter, checkpoint_path: str, *, name: str | None = None,
    every: str | None = None, available_now: bool = False,
) -> StreamingQuery:
    """Start a query that hands each micro-batch with its id to ``write``."""
    trigger = {"availableNow": True} if available_now else {"processingTime": every or "0 seconds"}
    writer = frame.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_path).trigger(**trigger)
    return (writer.queryName(name) if name else writer).start()


def batch_name(spark: SparkSession, batch_id: int) -> str:
    """A name for a batch that no other one has: ids begin anew with a checkpoint, and so does the query's id."""
    return f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"


# ---- Raw to Bronze and dead letters ---------------------------------------------------------------------------------------


def bronze_and_rejects(
    bronze_path: str, rejected_path: str, *, contract: str = CANDLE_CONTRACT, codec: str = "json",
    confluent_header: bool = False, dedup_key: Sequence[str] = DEDUP_KEY,
) -> BatchWriter:
    """Write a batch of Raw to both outputs: read once, decoded once.

    Events that Bronze has already are left out by comparison with the stored Bronze partitions of the batch's days, so
    there is no state, nothing is late, and each batch reads the keys of those partitions. Both outputs have a folder per
    batch above their own partitions.
    """
    schema = T.StructType([*BRONZE_SCHEMA.fields, T.StructField(BATCH, T.StringType())])

    def write(raw: DataFrame, batch_id: int) -> None:
        spark = raw.sparkSession
        name = batch_name(spark, batch_id)
        decoded = decode_payload(raw, contract, codec=codec, confluent_header=confluent_header).persist()
        try:
            valid = build_bronze_valid(decoded, dedup_key=dedup_key)
            if dataset_exists(spark, bronze_path):
                known = parquet_dataset(spark, bronze_path, schema).where(F.col(BATCH) != name)
                keys = list(dict.fromkeys([*dedup_key, *BRONZE_PARTITIONS]))
                valid = valid.join(known.select(*keys), keys, "left_anti").select(*valid.columns)
            write_parquet_dataset(valid, f"{bronze_path.rstrip('/')}/{BATCH}={name}", BRONZE_PARTITIONS)
            write_parquet_dataset(build_bronze_rejected(decoded), f"{rejected_path.rstrip('/')}/{BATCH}={name}")
        finally:
            decoded.unpersist()

    return write


def start_bronze_single(
    spark: SparkSession, raw_path: str, raw_schema: T.StructType, bronze_path: str, rejected_path: str, checkpoint_path: str,
    *, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER, trigger_interval: str | None = TRIGGER_INTERVAL,
    available_now: bool = False, **options,
) -> StreamingQuery:
    """One query from Raw to Bronze and dead letters, for ``options`` see ``bronze_and_rejects``."""
    raw = parquet_stream(spark, raw_path, raw_schema, max_files_per_trigger)
    write = bronze_and_rejects(bronze_path, rejected_path, **options)
    return start_batches(raw, write, checkpoint_path, name="bronze_market_candles", every=trigger_interval, available_now=available_now)


# ---- latest values ----------------------------------------------------------------------------------------------------------


def snapshot_merge(snapshot_path: str, context: ServingContext | None = None, *, now: Column | None = None) -> BatchWriter:
    """Merge a batch of indicators into the latest-value snapshot: by key, the latest opening counts.

    A row that is older than the stored one changes nothing, and of rows at one moment the batch's counts. A batch that the
    snapshot has had changes nothing either. Entries that have expired go.
    """
    context = context or ServingContext()

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query, _, number = (dataset_mark(spark, snapshot_path, MERGED) or "").rpartition("-")
        name = batch_name(spark, batch_id)
        if query == name.rpartition("-")[0] and int(number) >= batch_id:
            return
        fresh = latest_snapshot(market_indicators_latest(batch, context), now=now)
        merged = fresh.withColumn("_fresh", F.lit(1))
        if dataset_exists(spark, snapshot_path):
            moment = (F.current_timestamp() if now is None else now).cast("timestamp")
            kept = parquet_dataset(spark, snapshot_path, fresh.schema).where(F.col("expires_at_epoch") > F.unix_seconds(moment))
            both = merged.unionByName(kept.withColumn("_fresh", F.lit(0)))
            merged = first_by(both, SERIES_KEY, [F.col("open_time").desc_nulls_last(), F.col("_fresh").desc()])
        replace_parquet_dataset(merged.drop("_fresh"), snapshot_path, marks={MERGED: name})

    return merge


def start_snapshot(
    spark: SparkSession, gold_path: str, gold_schema: T.StructType, snapshot_path: str, checkpoint_path: str, *,
    context: ServingContext | None = None, now: Column | None = None, max_files_per_trigger: int | None = MAX_FILES_PER_TRIGGER,
    trigger_interval: str | None = TRIGGER_INTERVAL, available_now: bool = False,
) -> StreamingQuery:
    """Keep the latest-value snapshot up to date with the files of Gold as they arrive."""
    gold = parquet_stream(spark, gold_path, gold_schema, max_files_per_trigger)
    write = snapshot_merge(snapshot_path, context, now=now)
    return start_batches(gold, write, checkpoint_path, name="latest_snapshot", every=trigger_interval, available_now=available_now)
