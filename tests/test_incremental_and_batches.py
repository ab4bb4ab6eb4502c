"""Incremental layers against a full rebuild, batch writers under repetition, and the count of late rows."""

import os
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from candle_data import CANDLE, PROCESSED_AT
from pyspark.sql import functions as F
from test_streaming_and_jobs import candle_at, land

from candlelake.operators.bronze import calendar_columns
from candlelake.plans.incremental import run_gold_incremental, run_silver_incremental
from candlelake.plans.jobs import build_gold
from candlelake.plans.serving import ServingContext
from candlelake.schema import (
    BRONZE_PARTITIONS,
    BRONZE_SCHEMA,
    CANDLE_SCHEMA,
    GOLD_COLUMNS,
    GOLD_SCHEMA,
    INDICATOR_COLUMNS,
    KINESIS_RAW_SCHEMA,
    SILVER_SCHEMA,
)
from candlelake.sources.readers import parquet_dataset
from candlelake.sources.sinks import dataset_mark, write_parquet_dataset
from candlelake.streaming import batches
from candlelake.streaming.jobs import await_all, start_bronze
from candlelake.streaming.progress import LateRows

DAY = datetime(2024, 3, 1)


def candles(spark, rows):
    """(symbol, interval, hours, close) as Bronze; one-second labels make chunks of 18 hours, so days lie across them."""
    made = []
    for symbol, interval, hours, close in rows:
        moment = DAY + timedelta(hours=hours)
        made.append(
            dict(
                CANDLE, symbol=symbol, interval=interval, event_id=f"{symbol}:{interval}:{hours}:{close}", open_time=moment,
                close_time=moment + timedelta(seconds=1), open=float(close), high=close + 1.0, low=close - 1.0, close=float(close),
                ingested_at=moment,
            )
        )
    return calendar_columns(spark.createDataFrame(made, CANDLE_SCHEMA))


def add(spark, folder, rows):
    write_parquet_dataset(candles(spark, rows), f"{folder}/bronze", BRONZE_PARTITIONS, "append")


def update(spark, folder):
    silver = run_silver_incremental(spark, f"{folder}/bronze", f"{folder}/silver", f"{folder}/state")
    gold = run_gold_incremental(spark, f"{folder}/silver", f"{folder}/gold", f"{folder}/state")
    compare(spark, folder)
    return silver, gold


def compare(spark, folder):
    silver = parquet_dataset(spark, f"{folder}/silver", SILVER_SCHEMA)
    key = ["symbol", "interval", "open_time"]
    wanted = build_gold(silver).select(*GOLD_COLUMNS).toPandas().sort_values(key).reset_index(drop=True)
    actual = parquet_dataset(spark, f"{folder}/gold", GOLD_SCHEMA).select(*GOLD_COLUMNS).toPandas().sort_values(key).reset_index(drop=True)
    assert len(actual) == len(wanted) and actual[key].equals(wanted[key])
    for name in INDICATOR_COLUMNS:
        assert (actual[name].isna() == wanted[name].isna()).all(), name
        assert np.nanmax(np.abs(actual[name] - wanted[name]), initial=0) < 1e-9, name


def files(folder):
    found = {}
    for place, _, names in os.walk(f"{folder}/gold"):
        for name in names:
            if name.endswith(".parquet"):
                found.setdefault(os.path.relpath(place, f"{folder}/gold"), set()).add(name)
    return found


def test_incremental_layers_equal_a_full_rebuild(spark, tmp_path):
    folder, rng = str(tmp_path), np.random.default_rng(5)
    walk = lambda symbol, n, first=0: [(symbol, "1s", first + h, 100 + float(np.round(rng.normal() * 9, 3))) for h in range(n)]
    add(spark, folder, walk("A", 120) + walk("B", 120) + [("C", "1h", h, 50 + h % 7) for h in range(0, 120, 3)])
    silver, gold = update(spark, folder)
    assert silver.whole and gold.whole and gold.changed == 15
    before = files(folder)

    # Nothing new, nothing done.
    silver, gold = update(spark, folder)
    assert (silver.changed, gold.changed, files(folder)) == (0, 0, before)

    # One further day of B, and a late row of A on its third day.
    add(spark, folder, walk("B", 24, 120) + [("A", "1s", 60.5, 77.0)])
    silver, gold = update(spark, folder)
    assert (silver.changed, gold.changed, gold.whole) == (2, 2, False)
    after = files(folder)
    rewritten = {place for place in after if after[place] != before.get(place)}
    day = lambda k: (DAY + timedelta(days=k)).date().isoformat()
    assert rewritten == {f"event_date={day(k)}/symbol=A/interval=1s" for k in (2, 3, 4)} | {f"event_date={day(5)}/symbol=B/interval=1s"}

    # A new version of a candle, a new series, and a day whose only row no longer passes the rules.
    add(spark, folder, [("D", "1s", 3, 5.0)])
    update(spark, folder)
    later = candles(spark, [("A", "1s", 10, 140.0)]).withColumn("ingested_at", F.lit(DAY + timedelta(days=9)))
    write_parquet_dataset(later, f"{folder}/bronze", BRONZE_PARTITIONS, "append")
    bad = candles(spark, [("D", "1s", 3, 5.0)]).withColumn("close", F.lit(-1.0))
    write_parquet_dataset(bad, f"{folder}/bronze", BRONZE_PARTITIONS, dynamic=True)
    silver, gold = update(spark, folder)
    assert (silver.removed, gold.removed) == (1, 1)
    stored = parquet_dataset(spark, f"{folder}/gold", GOLD_SCHEMA)
    assert {r.symbol for r in stored.select("symbol").distinct().collect()} == {"A", "B", "C"}
    assert stored.where(F.col("symbol") == "A").agg(F.min("event_date")).first()[0] == date(2024, 3, 1)


def single(spark, folder, **options):
    paths = [f"{folder}/{name}" for name in ("bronze", "rejected", "checkpoint")]
    query = batches.start_bronze_single(spark, f"{folder}/raw", KINESIS_RAW_SCHEMA, *paths, available_now=True, codec="json", **options)
    await_all([query])
    return query


def test_one_query_writes_both_outputs_and_a_repeated_batch_changes_nothing(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    rows = lambda name: spark.read.parquet(f"{folder}/{name}")
    land(spark, folder, [candle_at(h) for h in range(4)] + [candle_at(0)], garbage=1)
    single(spark, folder)
    assert (rows("bronze").count(), rows("rejected").count()) == (4, 1)

    # The second batch fails after Bronze is written: it comes again under its id.
    land(spark, folder, [candle_at(h) for h in range(2, 6)], sequence=100, garbage=2)
    real, calls = batches.write_parquet_dataset, []

    def failing(frame, path, *args, **kwargs):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("the disk went away")
        real(frame, path, *args, **kwargs)

    monkeypatch.setattr(batches, "write_parquet_dataset", failing)
    with pytest.raises(Exception, match="disk went away"):
        single(spark, folder)
    monkeypatch.undo()
    query = single(spark, folder)
    assert rows("bronze").select("event_id").distinct().count() == rows("bronze").count() == 6
    assert rows("rejected").count() == 3 and calls[0].endswith("-1")
    # Raw was read once: the batch has as many input rows as were landed.
    assert query.lastProgress["numInputRows"] == 6
    assert set(BRONZE_SCHEMA.fieldNames()) <= set(rows("bronze").columns)


def gold_rows(spark, rows):
    frame = candles(spark, rows).select("symbol", "interval", "open_time", "close_time", "open", "high", "low", "close", "volume")
    return frame.withColumns({name: F.col("close") / 2 for name in INDICATOR_COLUMNS}).withColumn("event_date", F.to_date("open_time"))


def test_snapshot_stream_keeps_the_latest_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    folder, context = str(tmp_path), ServingContext(processing_timestamp=PROCESSED_AT)
    moment = lambda days: F.lit(PROCESSED_AT + timedelta(days=days)).cast("timestamp")

    def run(days):
        options = {"context": context, "now": moment(days), "available_now": True}
        query = batches.start_snapshot(spark, f"{folder}/gold", GOLD_SCHEMA, f"{folder}/latest", f"{folder}/checkpoint", **options)
        await_all([query])
        return query

    def entries():
        return {(r.symbol, r.interval): (r.open_time, r.close, r.expires_at_epoch) for r in spark.read.parquet(f"{folder}/latest").collect()}

    gold_rows(spark, [("A", "1h", 5, 1.0), ("A", "1h", 6, 2.0), ("B", "1h", 1, 3.0)]).write.parquet(f"{folder}/gold")
    run(0)
    first = entries()
    assert {k: v[1] for k, v in first.items()} == {("A", "1h"): 2.0, ("B", "1h"): 3.0}
    # An older row of A is no news, a newer one of B is; C is new.
    gold_rows(spark, [("A", "1h", 4, 9.0), ("B", "1h", 2, 4.0), ("C", "1h", 1, 5.0)]).write.mode("append").parquet(f"{folder}/gold")
    query = run(1)
    second = entries()
    assert second[("A", "1h")] == first[("A", "1h")] and second[("B", "1h")][1] == 4.0 and second[("C", "1h")][1] == 5.0
    assert second[("B", "1h")][2] == first[("B", "1h")][2] + 86400
    assert dataset_mark(spark, f"{folder}/latest", batches.MERGED) == f"{query.id}-1"

    # The same batch again, under the same id and a later clock.
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", str(query.id))
    try:
        merge = batches.snapshot_merge(f"{folder}/latest", context, now=moment(3))
        merge(gold_rows(spark, [("B", "1h", 2, 4.0)]), 1)
        assert entries() == second
        merge(gold_rows(spark, [("B", "1h", 2, 4.5)]), 2)
        assert entries()[("B", "1h")][1] == 4.5
        # All entries but a new one have expired by then.
        batches.snapshot_merge(f"{folder}/latest", context, now=moment(30))(gold_rows(spark, [("D", "1h", 1, 6.0)]), 3)
        assert set(entries()) == {("D", "1h")}
    finally:
        spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)


def test_late_rows_are_counted_beyond_the_progress_that_is_kept(spark, tmp_path):
    folder, kept = str(tmp_path), spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    listener = LateRows.of(spark)
    try:
        total = 0
        for phase, hours in enumerate(([200, 201], [5], [6, 7], [300], [8, 9, 10])):
            land(spark, folder, [candle_at(h) for h in hours], sequence=phase * 1000)
            query = start_bronze(
                spark, f"{folder}/raw", KINESIS_RAW_SCHEMA, f"{folder}/bronze", f"{folder}/checkpoint",
                rejected_path=f"{folder}/rejected", watermark_delay="1 day", available_now=True, spread=1,
            )
            await_all(query)
            total += len(hours) if hours[0] < 100 else 0
            assert listener.count(query[0]) == total
            assert listener.count(query[1]) == 0
        assert total == 6
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
