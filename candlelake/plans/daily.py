"""Daily summary from mergeable parts, kept up to date by the files of Gold that came or went.

A part says what a day's summary needs to know of some of its candles: ends by time, range, sums, and count, mean and
squared deviations of the close. Parts of disjoint candles merge in any order to the part of all of them. The state holds
one part for each file of Gold; a run reads the files it has not seen, and summarizes only the days that these or vanished
files belong to. The state is replaced last, so a run that fails is repeated with the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candlelake.config import under
from candlelake.plans.incremental import Rebuilt
from candlelake.plans.serving import SERVING_TABLES, ServingContext
from candlelake.schema import GOLD_SCHEMA
from candlelake.sources.intermediate import stored
from candlelake.sources.readers import parquet_dataset
from candlelake.sources.sinks import dataset_exists, drop_partitions, replace_parquet_dataset, write_parquet_dataset

DAY_KEY = ("symbol", "event_date")
DAILY = next(table for table in SERVING_TABLES if table.name == "market_daily_summary")
_FILE = ("_file", "_size", "_time")
_AVERAGED = ("rsi_14", "macd")


def daily_parts(candles: DataFrame, *within: str) -> DataFrame:
    """A part per symbol and day, or per further columns within a day; a hash aggregation of fixed width."""
    n = F.count("close")
    averages = [f(name).alias(f"{name}_{kind}") for name in _AVERAGED for kind, f in (("n", F.count), ("sum", F.sum))]
    return candles.groupBy(*DAY_KEY, *within).agg(
        F.min("open_time").alias("opened"),
        F.min_by("open", "open_time").alias("open"),
        F.max("open_time").alias("closed"),
        F.max_by("close", "open_time").alias("close"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.sum("volume").alias("volume"),
        *averages,
        n.alias("n"),
        F.avg("close").alias("mean"),
        (F.var_pop("close") * n).alias("m2"),
    )


def summarize_days(parts: DataFrame, context: ServingContext) -> DataFrame:
    """The rows of ``market_daily_summary`` from parts of disjoint candles.

    The deviation is taken from the mean of the day and of each part, so it does not cancel where prices are large. A day
    has as many parts as files, and window and aggregate share one shuffle.
    """
    day = Window.partitionBy(*DAY_KEY)
    mean = F.try_divide(F.sum(F.col("mean") * F.col("n")).over(day), F.sum("n").over(day))
    shifted = parts.withColumn("_shift", F.col("mean") - mean)
    n, squares = F.sum("n"), F.sum(F.col("m2") + F.col("n") * F.col("_shift") * F.col("_shift"))

    def average(name: str) -> Column:
        return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(f"avg_{name}")

    return shifted.groupBy(*DAY_KEY).agg(
        F.min_by("open", "opened").alias("open_price"),
        F.max_by("close", "closed").alias("close_price"),
        F.max("high").alias("high_price"),
        F.min("low").alias("low_price"),
        F.sum("volume").alias("daily_volume"),
        *[average(name) for name in _AVERAGED],
        F.coalesce(F.sqrt(F.try_divide(squares, F.when(n > 1, n - 1))), F.lit(0.0)).alias("volatility_score"),
    ).withColumn("generated_at", context.processed_at())


def run_daily_incremental(
    spark: SparkSession, gold_path: str, output_base_path: str, state_path: str, context: ServingContext
) -> Rebuilt:
    """The daily summary, of days whose files in Gold changed; other days keep their rows and stamps.

    The first run, or one without a summary, reads all of Gold. Another base interval makes all stored parts vanish, so
    it needs no care. Rows without symbol or day, of which Silver lets none through, have no summary.
    """
    target, parts_path = under(output_base_path, DAILY.name), under(state_path, "daily_parts")
    gold = parquet_dataset(spark, gold_path, GOLD_SCHEMA)
    of_file = [F.col(f"_metadata.{name}").alias(to) for name, to in zip(("file_path", "file_size", "file_modification_time"), _FILE, strict=True)]
    known_day = F.col("symbol").isNotNull() & F.col("event_date").isNotNull()
    candles = gold.where((F.col("interval") == context.base_interval) & known_day).select("*", *of_file)
    # No data column is read for the list of files.
    files = stored(candles.select(*DAY_KEY, *_FILE).distinct())
    if not (dataset_exists(spark, parts_path) and dataset_exists(spark, target)):
        parts = stored(daily_parts(candles, *_FILE))
        replace_parquet_dataset(summarize_days(parts, context), target, DAILY.partition_columns)
        replace_parquet_dataset(parts, parts_path)
        return Rebuilt(True, parts.select(*DAY_KEY).distinct().count())
    known = spark.read.parquet(parts_path)
    fresh = files.join(known, list(_FILE), "left_anti")
    gone = known.join(files, list(_FILE), "left_anti")
    days = stored(fresh.select(*DAY_KEY).union(gone.select(*DAY_KEY)).distinct())
    n = days.count()
    if not n:
        return Rebuilt(False, 0)
    # The days prune the scan to their folders, the files are then told apart by name.
    read = daily_parts(candles.join(fresh, [*DAY_KEY, *_FILE], "left_semi"), *_FILE)
    parts = stored(known.join(files, list(_FILE), "left_semi").unionByName(read))
    summary = stored(summarize_days(parts.join(days, list(DAY_KEY), "left_semi"), context))
    write_parquet_dataset(summary, target, DAILY.partition_columns, dynamic=True)
    empty = days.join(summary, list(DAY_KEY), "left_anti").select(*DAILY.partition_columns)
    removed = drop_partitions(spark, target, empty)
    replace_parquet_dataset(parts, parts_path)
    return Rebuilt(False, n, removed)
