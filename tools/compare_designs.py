"""Two comparisons of designs at growing series length: ``compare_designs.py [rows ...]``, one JSON line for each length.

The EMA in chunks with carries against its closed form over whole series (one window, powers of the whole length), and the
as-of join in one scan against an inequality join reduced to the latest partner. Seconds are medians of three runs after a
warm-up; ``closed_form_finite`` is the share of rows for which the closed form is still a number.
"""

from __future__ import annotations

import json
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from candlelake.operators.asof import asof_join  # noqa: E402
from candlelake.operators.indicators import ema  # noqa: E402

ALPHA, SERIES, LONGEST_INEQUALITY = 2.0 / 13.0, 8, 20_000


def candles(spark: SparkSession, rows: int) -> DataFrame:
    moment = F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 60)
    prices = spark.range(rows).select(moment.alias("open_time"), moment.alias("close_time"), (100 + F.sin("id")).alias("close"))
    symbols = F.explode(F.array(*[F.lit(f"S{k}") for k in range(SERIES)])).alias("symbol")
    return prices.select("*", symbols, F.lit("1m").alias("interval"))


def closed_form(frame: DataFrame) -> DataFrame:
    series = Window.partitionBy("symbol", "interval").orderBy("open_time")
    place = F.row_number().over(series) - 1
    decay = F.pow(F.lit(1 - ALPHA), F.col("_i"))
    weighted = F.when(F.col("_i") == 0, F.col("close")).otherwise(ALPHA * F.col("close") / decay)
    return frame.withColumn("_i", place).withColumn("e", F.sum(weighted).over(series) * decay)


def inequality_join(left: DataFrame, right: DataFrame) -> DataFrame:
    met = left.join(right, (F.col("symbol") == F.col("r_symbol")) & (F.col("at") <= F.col("open_time")), "left")
    return met.groupBy("symbol", "open_time").agg(F.max(F.struct("at", "v")).alias("match"))


def seconds(build) -> float:
    taken = []
    for _ in range(4):
        started = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - started)
    return round(statistics.median(taken[1:]), 3)


def main() -> None:
    lengths = [int(word) for word in sys.argv[1:]] or [1_000, 4_000, 16_000, 256_000]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for rows in lengths:
        frame = candles(spark, rows)
        right = frame.where(F.minute("open_time") % 15 == 0).select(F.col("symbol").alias("r_symbol"), F.col("open_time").alias("at"), F.col("close").alias("v"))
        finite = closed_form(frame).agg(F.avg((F.col("e").isNotNull() & ~F.isnan("e") & (F.abs("e") < 1e9)).cast("int"))).first()[0]
        other = right.withColumnRenamed("r_symbol", "symbol")
        joined = lambda: asof_join(frame, other, by=["symbol"], left_on="open_time", right_on="at", columns=["v"])  # noqa: E731, B023
        row = {
            "rows_per_series": rows,
            "ema_scan": seconds(lambda: ema(frame, "close", "e", ALPHA)),  # noqa: B023
            "ema_closed_form": seconds(lambda: closed_form(frame)),  # noqa: B023
            "closed_form_finite": round(finite, 4),
            "asof_scan": seconds(joined),
            "asof_inequality": seconds(lambda: inequality_join(frame, right)) if rows <= LONGEST_INEQUALITY else None,  # noqa: B023
        }
        print(json.dumps(row), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
