"""What several operators share: the shared scratch folder, global row numbers, ordered chunks and word patterns."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from bisect import bisect_right
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of anything but ASCII white space, as ``bytes.split()`` has it.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"
POSITION_BITS = 33
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 8_000_000
MOST_CHUNKS = 20_000


def worker_store(name: str) -> dict:
    """A dictionary that lives as long as the Python worker, beside functions that are unpickled for each task.

    A worker serves many stages; asking for one store lets go of the others, so their sizes never add up.
    """
    holder = sys.modules.setdefault("llm_worker_store", types.ModuleType("llm_worker_store"))
    stores = holder.__dict__.setdefault("stores", {})
    for other in [k for k in stores if k != name]:
        stores.pop(other)
    return stores.setdefault(name, {})


def scratch(spark: SparkSession) -> str:
    """A new folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where that is unset, a session on one machine gets a folder of its own; on a cluster it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="llm-")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """Cut the lineage: write the frame to the shared folder and read it again."""
    spark, path = frame.sparkSession, scratch(frame.sparkSession)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long"), F.lit(0).cast("long"))


def small(frame: DataFrame, text_column: str | None = None) -> DataFrame:
    """A broadcast hint if a count proves the frame small, else the frame itself, left to a shuffled join."""
    length = F.sum(F.octet_length(text_column)) if text_column else F.lit(0)
    rows, size = frame.agg(F.count(F.lit(1)), F.coalesce(length, F.lit(0))).first()
    return F.broadcast(frame) if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES else frame


def number_rows(frame: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Stored rows with a gapless global number from 0 in the given order.

    Rows are range-partitioned and sorted; a row's number is its place in its partition plus the rows of the
    partitions before. Only one count per partition meets in one task.
    """
    place, part, before = (f"__{name}_{x}" for x in ("place", "part", "before"))
    laid = stored(
        frame.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id())
    )
    part_of = F.shiftright(place, POSITION_BITS)
    counts = laid.groupBy(part_of.alias(part)).agg(F.count(F.lit(1)).alias("n"))
    running = F.expr(f"coalesce(sum(n) OVER (ORDER BY {part} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    offsets = counts.select(part, running.alias(before))
    # One row per partition, so its size is bounded by the number of partitions.
    joined = laid.withColumn(part, part_of).join(F.broadcast(offsets), part)
    position = F.col(place).bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return joined.withColumn(name, F.col(before) + position).drop(place, part, before)


def ordered_chunks(frame: DataFrame, rows: int, chunk: str) -> tuple[DataFrame, int]:
    """Add to (doc_id, text) the number of a chunk; chunks follow each other by id, nulls last, then by a hash of the text.

    The bounds are every ``rows``-th pair of id and hash in their global order, so rows without an id and rows of one id
    are cut like any others; rows equal in both share a chunk. From ``MOST_CHUNKS`` chunks on, which are what the driver
    holds, chunks grow instead: whoever reads one has to stream it.
    """
    order = [F.col("doc_id").asc_nulls_last(), F.col("__hash")]
    numbered = stored(number_rows(frame.select("doc_id", F.xxhash64("text").alias("__hash")), order, "__n"))
    every = max(rows, -(-numbered.count() // MOST_CHUNKS))
    cuts = numbered.where((F.col("__n") % every == 0) & (F.col("__n") > 0)).select("doc_id", "__hash").collect()
    bounds = sorted({(r[0] is None, r[0] or 0, r[1]) for r in cuts})

    @F.pandas_udf(T.IntegerType())
    def chunk_of(ids: pd.Series, missing: pd.Series, hashes: pd.Series) -> pd.Series:
        places = [bisect_right(bounds, key) for key in zip(missing.tolist(), ids.tolist(), hashes.tolist(), strict=True)]
        return pd.Series(places, dtype=np.int32)

    doc_id = F.col("doc_id")
    return frame.withColumn(chunk, chunk_of(F.coalesce(doc_id, F.lit(0).cast("long")), doc_id.isNull(), F.xxhash64("text"))), len(bounds) + 1
