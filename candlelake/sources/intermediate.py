"""Tables that a job writes for itself: in the folder of the session's checkpoints, which driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder in ``spark.checkpoint.dir``.

    Where the session names none, a session of one machine gets one of its own; on a cluster that is an error, since
    executors do not share local folders.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="candlelake-")
    return f"{base.rstrip('/')}/candlelake-{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """The frame, written once and read again: what is built on it neither repeats its work nor depends on its executors."""
    spark, path = frame.sparkSession, scratch(frame.sparkSession)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
