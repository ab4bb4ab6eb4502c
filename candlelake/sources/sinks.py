"""Batch and streaming sinks.

A stream goes to a ``StreamSink``, which says where its rows go and how; ``start`` is the one place that starts a
query. Batch writers cluster rows by output partition and replace a dataset only when the new one is complete.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def cluster_for_write(frame: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Bring the rows of each output partition together, in files of about the advisory size.

    Without it every task writes a file into every partition it has rows of. The rebalance hint lets
    Spark split a partition that is large, so one hot series does not become one task.
    """
    return frame.hint("rebalance", *partition_columns) if partition_columns else frame


def write_parquet_dataset(
    frame: DataFrame,
    path: str,
    partition_columns: Sequence[str] = (),
    mode: str = "overwrite",
    *,
    dynamic: bool = False,
    cluster: bool = True,
) -> None:
    """Write a dataset. ``dynamic`` overwrites only the partitions the frame has rows for."""
    writer = (cluster_for_write(frame, partition_columns) if cluster else frame).write.mode(mode)
    if partition_columns:
        writer = writer.partitionBy(*partition_columns)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


def _place(spark: SparkSession, path: str):
    """The file system of a path, and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def dataset_exists(spark: SparkSession, path: str) -> bool:
    system, place = _place(spark, path)
    return system.exists(place)


def dataset_mark(spark: SparkSession, path: str, name: str) -> str | None:
    """What ``replace_parquet_dataset`` has left with a dataset under this name."""
    system, place = _place(spark, f"{path.rstrip('/')}/{name}")
    if not system.exists(place):
        return None
    source = system.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def replace_mark(spark: SparkSession, path: str, name: str, text: str) -> None:
    """Put a small file with a dataset, in place of an older one by a single rename that overwrites it."""
    fresh = f"{path.rstrip('/')}/{name}.{uuid.uuid4().hex}"
    system, source = _place(spark, fresh)
    _write_text(system, source, text)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    files.rename(source, _place(spark, f"{path.rstrip('/')}/{name}")[1], options)


def _write_text(system, place, text: str) -> None:
    out = system.create(place)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def replace_parquet_dataset(
    frame: DataFrame, path: str, partition_columns: Sequence[str] = (), *, marks: Mapping[str, str] | None = None
) -> None:
    """Replace a dataset as a whole: the new one is written beside it and takes its place when complete.

    A job that fails leaves the old dataset as it was, and the frame may read the dataset it replaces. ``marks`` are small
    files that come and go with the dataset; their names begin with an underscore, so that they are not read as data.
    Between its two renames there is no dataset for a moment: a reader that meets it tries again.
    """
    spark, mark = frame.sparkSession, uuid.uuid4().hex
    fresh, gone = f"{path.rstrip('/')}.new-{mark}", f"{path.rstrip('/')}.old-{mark}"
    write_parquet_dataset(frame, fresh, partition_columns, "errorifexists")
    system, place = _place(spark, path)
    for name, text in (marks or {}).items():
        _write_text(system, _place(spark, f"{fresh}/{name}")[1], text)
    retired = _place(spark, gone)[1]
    had_one = system.exists(place)
    if had_one and not system.rename(place, retired):
        raise OSError(f"could not set {path} aside")
    if not system.rename(_place(spark, fresh)[1], place):
        if had_one:
            system.rename(retired, place)
        raise OSError(f"could not put the new dataset at {path}")
    if had_one:
        system.delete(retired, True)


def drop_partitions(spark: SparkSession, path: str, partitions: DataFrame) -> int:
    """Remove the partitions of a dataset that the rows of ``partitions`` name, a column for each level; their number.

    For partitions that a dynamic overwrite has no rows for, and so leaves as they were.
    """
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    shown = [F.col(name).cast("string").alias(name) for name in partitions.columns]
    removed = 0
    for row in partitions.distinct().select(*shown).toLocalIterator():
        place = "/".join([path.rstrip("/"), *[escape(name, row[name]) for name in partitions.columns]])
        system, folder = _place(spark, place)
        removed += bool(system.exists(folder) and system.delete(folder, True))
    return removed


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_table(
    frame: DataFrame,
    database: str,
    table: str,
    partition_columns: Sequence[str] = (),
    mode: str = "overwrite",
    *,
    location: str | None = None,
    cluster: bool = True,
) -> None:
    """Write a Parquet table of the catalog; a database that is missing is made, at ``location`` if given."""
    where = f" LOCATION {_text(location)}" if location else ""
    frame.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{where}")
    laid = cluster_for_write(frame, partition_columns) if cluster else frame
    laid.write.saveAsTable(
        f"{_quoted(database)}.{_quoted(table)}",
        format="parquet",
        mode=mode,
        partitionBy=list(partition_columns) or None,
    )


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    *,
    schema: str = "public",
    driver: str = "org.postgresql.Driver",
    num_partitions: int | None = None,
    batch_size: int | None = None,
) -> dict[str, str]:
    """Options of a table write that empties the table instead of dropping it.

    A table without a schema of its own is in ``schema``; ``num_partitions`` bounds the connections open at once.
    """
    parts = table.rpartition(".")
    asked = {
        "url": url,
        "dbtable": ".".join((parts[0] or schema, parts[2])),
        "user": user,
        "password": password,
        "driver": driver,
        "truncate": "true",
        "numPartitions": num_partitions,
        "batchsize": batch_size,
    }
    return {name: str(value) for name, value in asked.items() if value is not None}


def write_jdbc_table(
    frame: DataFrame,
    url: str,
    table: str,
    user: str,
    password: str,
    mode: str = "overwrite",
    **options,
) -> None:
    frame.write.save(format="jdbc", mode=mode, **jdbc_options(url, table, user, password, **options))


def kafka_sink_options(bootstrap_servers: str, topic: str) -> dict[str, str]:
    """Options of an idempotent, fully acknowledged, compressed producer."""
    return {
        "kafka.bootstrap.servers": bootstrap_servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.compression.type": "snappy",
    }


def keyed_messages(frame: DataFrame) -> DataFrame:
    """``key`` and ``value`` for a topic; rows of a Kinesis stream are keyed by their partition key."""
    key = next((name for name in ("key", "partition_key") if name in frame.columns), None)
    return frame.select((F.lit(None).cast("string") if key is None else F.col(key)).alias("key"), "value")


def write_kafka(frame: DataFrame, bootstrap_servers: str, topic: str) -> None:
    """Send the ``key`` and ``value`` columns of a batch to a topic."""
    keyed_messages(frame).write.save(format="kafka", **kafka_sink_options(bootstrap_servers, topic))


@dataclass(frozen=True)
class StreamSink:
    """Where a stream goes: a format with its options, the output partitions, and the query's checkpoint and name."""

    format: str
    checkpoint: str
    options: Mapping[str, str] = field(default_factory=dict)
    partitions: tuple[str, ...] = ()
    name: str | None = None

    @classmethod
    def dataset(cls, path: str, checkpoint: str, partitions: Sequence[str] = (), name: str | None = None) -> StreamSink:
        """A Parquet dataset that the stream is appended to."""
        return cls("parquet", checkpoint, {"path": path}, tuple(partitions), name)

    @classmethod
    def topic(cls, bootstrap_servers: str, topic: str, checkpoint: str, name: str | None = None) -> StreamSink:
        """A Kafka topic; needs Spark's Kafka connector."""
        return cls("kafka", checkpoint, kafka_sink_options(bootstrap_servers, topic), (), name)

    def start(self, frame: DataFrame, *, every: str | None = None, available_now: bool = False) -> StreamingQuery:
        """Start the query: over what is there and no more (``available_now``), ``every`` so often, or at once."""
        rows = keyed_messages(frame) if self.format == "kafka" else frame
        trigger = {"availableNow": True} if available_now else {"processingTime": every or "0 seconds"}
        return rows.writeStream.trigger(**trigger).start(
            format=self.format,
            outputMode="append",
            partitionBy=list(self.partitions) or None,
            queryName=self.name,
            checkpointLocation=self.checkpoint,
            **self.options,
        )
