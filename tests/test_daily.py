"""The daily summary from stored parts against one from all rows, over late rows, replaced and removed days."""

import os
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from candlelake.plans.daily import daily_parts, run_daily_incremental, summarize_days
from candlelake.plans.serving import ServingContext, market_daily_summary
from candlelake.schema import GOLD_PARTITIONS, GOLD_SCHEMA
from candlelake.sources.readers import parquet_dataset
from candlelake.sources.sinks import write_parquet_dataset

DAY = datetime(2024, 5, 1)
CONTEXT = ServingContext(processing_timestamp=datetime(2024, 6, 1))


def gold(spark, rows):
    """(symbol, interval, minute, close) as Gold; other numbers follow from the close, the indicators may be missing."""
    made = []
    for symbol, interval, minute, close in rows:
        moment = DAY + timedelta(minutes=minute)
        row = dict.fromkeys(GOLD_SCHEMA.names)
        row |= dict(symbol=symbol, interval=interval, open_time=moment, close_time=moment, event_date=moment.date(), close=close)
        if close is not None:
            row |= dict(open=close - 0.5, high=close + 1, low=close - 1, volume=close / 3)
            row |= dict(rsi_14=None if minute % 5 == 0 else close % 100, macd=close / 7)
        made.append(row)
    return spark.createDataFrame(made, GOLD_SCHEMA)


def table(frame):
    return frame.toPandas().sort_values(["symbol", "event_date"]).reset_index(drop=True)


def same(actual, wanted):
    actual, wanted = table(actual), table(wanted)[list(actual.columns)]
    assert len(actual) == len(wanted) and set(actual.columns) == set(wanted.columns)
    for name in wanted.columns:
        if wanted[name].dtype == float:
            assert np.allclose(actual[name].astype(float), wanted[name], rtol=1e-9, atol=1e-9, equal_nan=True), name
        else:
            assert actual[name].equals(wanted[name]), name


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_parts_merge_to_the_summary_of_all_rows(spark, parts):
    rng = np.random.default_rng(parts)
    # Prices that are large against their moves: sums of squares would cancel to about 1e-6.
    rows = [(s, "1m", int(m), 1e5 + float(rng.normal())) for s in ("A", "B") for m in rng.choice(4000, 300, replace=False)]
    rows += [("C", "1m", 3, 5.0), ("D", "1m", 4, None), ("D", "1m", 5, 7.0), ("E", "1m", 6, None), ("F", "1h", 7, 8.0)]
    frame = gold(spark, rows)
    split = daily_parts(frame.where("interval = '1m'").withColumn("part", F.minute("open_time") % parts), "part")
    same(summarize_days(split, CONTEXT), market_daily_summary(frame, CONTEXT))


def test_empty(spark):
    assert summarize_days(daily_parts(gold(spark, [])), CONTEXT).count() == 0


def test_summary_follows_the_files_of_gold(spark, tmp_path):
    folder, rng = str(tmp_path), np.random.default_rng(3)
    walk = lambda symbol, minutes: [(symbol, "1m", m, 100 + float(rng.normal() * 9)) for m in minutes]

    def add(rows, mode="append", **options):
        write_parquet_dataset(gold(spark, rows), f"{folder}/gold", GOLD_PARTITIONS, mode, **options)

    def update(context=CONTEXT):
        done = run_daily_incremental(spark, f"{folder}/gold", f"{folder}/serving", f"{folder}/state", context)
        stored = spark.read.parquet(f"{folder}/serving/market_daily_summary")
        same(stored, market_daily_summary(parquet_dataset(spark, f"{folder}/gold", GOLD_SCHEMA), context))
        return done

    def files():
        places = os.walk(f"{folder}/serving/market_daily_summary")
        return {os.path.basename(place) + "/" + os.path.basename(os.path.dirname(place)): set(n) for place, _, n in places if "symbol=" in place}

    add(walk("A", range(0, 4000, 50)) + walk("B", range(0, 4000, 70)) + [("A", "1h", 60, 1.0)])
    first = update()
    assert first.whole and first.changed == 6
    before = files()
    assert update().changed == 0 and files() == before

    # A late row that becomes the first of its day, a new day, and a context candle that changes nothing.
    add([("A", "1m", 1441, 55.0), ("B", "1m", 4400, 60.0), ("A", "1h", 120, 2.0)])
    done = update()
    assert (done.changed, done.removed, done.whole) == (2, 0, False)
    after = files()
    assert {place for place in after if after[place] != before.get(place)} == {"symbol=A/event_date=2024-05-02", "symbol=B/event_date=2024-05-04"}

    # A day rewritten with fewer rows, and one whose files are gone.
    add([("B", "1m", 10, 9.0)], "overwrite", dynamic=True)
    gone = f"{folder}/gold/event_date=2024-05-01/symbol=A/interval=1m"
    for name in os.listdir(gone):
        os.remove(f"{gone}/{name}")
    done = update()
    assert (done.changed, done.removed) == (2, 1)

    # Without its state everything is summarized again; so it is for another base interval.
    hourly = ServingContext(base_interval="1h", processing_timestamp=CONTEXT.processing_timestamp)
    assert not update(hourly).whole
