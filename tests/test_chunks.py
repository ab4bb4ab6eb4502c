"""Chunks by count: bursts and moments with very many rows are cut, and results stay what they were."""

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlelake.operators.asof import asof_join
from candlelake.operators.chunks import SPLITS, measured_chunks
from candlelake.operators.indicators import with_indicators
from candlelake.operators.scan import CHUNK, CHUNK_CANDLES, previous_value, sequence_index
from candlelake.schema import INDICATOR_COLUMNS, SERIES_KEY

START = datetime(2024, 1, 1)


def hourly(spark, n):
    moment = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 3600)
    return spark.range(n).select(F.lit("A").alias("symbol"), F.lit("1h").alias("interval"), moment.alias("open_time"))


def burst(spark, n):
    """Rows within one hour, nine milliseconds apart."""
    moment = F.timestamp_micros(F.lit(1_704_067_200_000_000 + 500 * 3_600_000_000) + F.col("id") * 9000)
    return spark.range(n).select(F.lit("A").alias("symbol"), F.lit("1h").alias("interval"), moment.alias("open_time"))


def test_a_burst_among_hourly_rows_is_cut(spark):
    frame = hourly(spark, 18_000).unionByName(burst(spark, 400_000))
    chunks = measured_chunks(frame, SERIES_KEY, "open_time")
    numbered = chunks.number(frame, "open_time")
    per = numbered.groupBy(CHUNK).agg(F.count("*").alias("n"), F.min("open_time").alias("a"), F.max("open_time").alias("b"))
    rows = per.orderBy(CHUNK).collect()
    assert sum(r["n"] for r in rows) == 418_000 and max(r["n"] for r in rows) <= 2 * CHUNK_CANDLES
    # Chunks are numbered along time from 0 and do not overlap.
    assert [r[CHUNK] for r in rows] == list(range(len(rows))) and len(rows) >= 6
    assert all(left["b"] < right["a"] for left, right in zip(rows, rows[1:], strict=False))


def test_even_series_need_no_join(spark):
    chunks = measured_chunks(hourly(spark, 3000), SERIES_KEY, "open_time")
    assert chunks.levels == () and chunks.split is None
    assert "Join" not in chunks.number(hourly(spark, 3000), "open_time")._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def bursts(spark):
    """Three series: one with a burst, an even one, and one with rows without a time."""
    rng = np.random.default_rng(3)
    rows = []
    for symbol, gaps in (("BURST", [60] * 300 + [0.001] * 700 + [60] * 100), ("EVEN", [60] * 500), ("NULLS", [60] * 50)):
        moment = START
        for gap, step in zip(gaps, rng.normal(size=len(gaps)), strict=True):
            moment += timedelta(seconds=gap)
            rows.append((symbol, "1m", moment, moment + timedelta(seconds=59), float(100 + 10 * step)))
    # A row without times comes first, so its price is what the averages start from.
    rows.append(("NULLS", "1m", None, None, 100.0))
    return spark.createDataFrame(rows, "symbol string, interval string, open_time timestamp, close_time timestamp, close double").cache()


def test_scans_are_the_same_for_chunks_by_count(bursts):
    rows = 64
    chunks = measured_chunks(bursts, SERIES_KEY, "open_time", rows=rows)
    assert len(chunks.levels) > 1
    assert chunks.number(bursts, "open_time").groupBy("symbol", CHUNK).count().agg(F.max("count")).first()[0] <= 2 * rows

    def scanned(way):
        frame = previous_value(sequence_index(bursts, "i", chunk_seconds=way), "close", "p", chunk_seconds=way)
        return frame.toPandas().sort_values(["symbol", "open_time"], na_position="first").reset_index(drop=True)

    actual, wanted = scanned(chunks), scanned(10**9)
    assert actual.equals(wanted)
    assert (actual["i"] == actual.groupby("symbol").cumcount()).all()
    shown = ["symbol", "open_time", *INDICATOR_COLUMNS]
    left, right = (
        with_indicators(bursts, way).toPandas().sort_values(["symbol", "open_time"], na_position="first")[shown].reset_index(drop=True)
        for way in (chunks, 10**9)
    )
    assert left[["symbol", "open_time"]].equals(right[["symbol", "open_time"]])
    for name in INDICATOR_COLUMNS:
        assert (left[name].isna() == right[name].isna()).all() and np.nanmax(np.abs(left[name] - right[name])) < 1e-9


def test_rows_without_a_time_come_first(spark):
    rows = [("A", "1m", None, 5.0), ("A", "1m", START, 6.0), ("A", "1m", START + timedelta(minutes=1), 7.0)]
    frame = spark.createDataFrame(rows, "symbol string, interval string, open_time timestamp, x double")
    found = previous_value(sequence_index(frame, "i", order=["open_time"]), "x", "before", order=["open_time"])
    assert sorted((r["x"], r["i"], r["before"]) for r in found.collect()) == [(5.0, 0, None), (6.0, 1, 5.0), (7.0, 2, 6.0)]


def test_a_moment_with_most_rows_is_split_and_matches_as_before(spark):
    moment = F.timestamp_seconds(F.lit(1_704_067_200) + F.when(F.col("id") < 4000, F.lit(5000)).otherwise(F.col("id") - 4000))
    left = spark.range(10_000).select(F.lit("k").alias("k"), F.col("id").alias("tag"), moment.alias("t"))
    right = spark.range(700).select(F.lit("k").alias("k"), F.timestamp_seconds(F.lit(1_704_067_195) + F.col("id") * 10).alias("at"), F.col("id").alias("v"))
    both = left.select("k", F.col("t").alias("_time")).unionByName(right.select("k", F.col("at").alias("_time")))
    chunks = measured_chunks(both, ["k"], "_time", rows=300)
    parts = {r[CHUNK]: r[SPLITS] for r in chunks.split.collect()}
    assert len(parts) == 1 and max(parts.values()) >= 6
    options = {"by": ["k"], "left_on": "t", "right_on": "at", "columns": ["v"]}
    split = asof_join(left, right, chunk_seconds=chunks, **options)
    plain = asof_join(left, right, chunk_seconds=10**9, **options)
    read = lambda frame: sorted((r["tag"], r["match"]["v"] if r["match"] else None) for r in frame.collect())
    assert read(split) == read(plain) and split.count() == 10_000


def scans(frame):
    plan = frame._jdf.queryExecution().executedPlan()
    text = plan.toString().split("== Initial Plan ==")[0]
    return text.count("FileScan") or text.count("Scan ")


def final_scans(frame):
    frame.collect()
    return scans(frame)


def test_each_source_is_read_twice_at_most(spark, tmp_path, bursts):
    bursts.write.parquet(f"{tmp_path}/silver")
    silver = spark.read.parquet(f"{tmp_path}/silver")
    assert final_scans(with_indicators(silver)) == 2
    other = spark.read.parquet(f"{tmp_path}/silver").select("symbol", F.col("open_time").alias("at"), F.col("close").alias("v"))
    joined = asof_join(silver, other, by=["symbol"], left_on="open_time", right_on="at", columns=["v"])
    assert final_scans(joined) == 4
