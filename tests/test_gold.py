"""Indicators against plain recursion, on one chunk and on many."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from candle_data import bar, golden_rows
from pyspark.sql import functions as F

from candlelake.operators.indicators import calculate_indicators, ema, with_indicators
from candlelake.operators.scan import latest_by_key, previous_value, sequence_index
from candlelake.plans.jobs import build_gold
from candlelake.schema import GOLD_COLUMNS, GOLD_SOURCE_COLUMNS, INDICATOR_COLUMNS


def recursion(values, alpha, start):
    out = np.full(len(values), np.nan)
    if len(values) > start:
        out[start] = values[start]
        for i in range(start + 1, len(values)):
            out[i] = alpha * values[i] + (1 - alpha) * out[i - 1]
    return out


def expected(group):
    close = group["close"].to_numpy()
    delta = np.diff(close, prepend=close[0])
    gain = recursion(np.maximum(delta, 0), 1 / 14, 1)
    loss = recursion(np.maximum(-delta, 0), 1 / 14, 1)
    ema_12, ema_26 = recursion(close, 2 / 13, 0), recursion(close, 2 / 27, 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        rsi = 100 - 100 / (1 + gain / loss)
    rsi = np.where(loss == 0, np.where(gain > 0, 100.0, 50.0), rsi)
    rsi[0] = np.nan
    series = pd.Series(close, index=group.index)
    middle = series.rolling(20, min_periods=1).mean()
    width = 2 * series.rolling(20, min_periods=1).apply(np.std, raw=True)
    return pd.DataFrame(
        {
            "ema_12": ema_12,
            "ema_26": ema_26,
            "macd": ema_12 - ema_26,
            "rsi_14": rsi,
            "bollinger_middle": middle,
            "bollinger_upper": middle + width,
            "bollinger_lower": middle - width,
        },
        index=group.index,
    )


def compare(frame):
    actual = frame.toPandas().sort_values(["symbol", "open_time"]).reset_index(drop=True)
    wanted = pd.concat([expected(group) for _, group in actual.groupby("symbol")])
    for name in INDICATOR_COLUMNS:
        assert (actual[name].isna() == wanted[name].isna()).all(), name
        assert np.nanmax(np.abs(actual[name] - wanted[name])) < 1e-8, name


@pytest.fixture(scope="module")
def walks(spark):
    rng = np.random.default_rng(7)
    start = datetime(2024, 1, 1)
    rows = []
    for symbol, count, gaps in (("DENSE", 6000, 1), ("SPARSE", 400, 500), ("TWO", 2, 1), ("ONE", 1, 1)):
        at = np.cumsum(rng.integers(1, gaps + 1, count))
        closes = np.abs(100 + np.cumsum(rng.normal(size=count))) + 1
        for minutes, close in zip(at, closes, strict=True):
            rows.append(
                bar(symbol, "1m", start + timedelta(minutes=int(minutes)), close, timedelta(seconds=59))
            )
    # Rising, then flat: both Wilder averages must survive a long run of zero moves.
    for i in range(1500):
        rows.append(
            bar("FLAT", "1m", start + timedelta(minutes=i), min(i, 40) + 1, timedelta(seconds=59))
        )
    return spark.createDataFrame(rows, GOLD_SOURCE_COLUMNS).repartition(5).cache()


@pytest.mark.parametrize("chunk_seconds", [None, 600, 36000, 180000])
def test_indicators_match_recursion_for_any_chunk_length(walks, chunk_seconds):
    compare(with_indicators(walks, chunk_seconds))


def test_several_rows_per_step_open_further_blocks(walks):
    compare(with_indicators(walks, 10_000_000))


def test_first_row_of_a_series_is_exact(walks):
    first = (
        sequence_index(calculate_indicators(walks)).filter("_row_index = 0").select("close", *INDICATOR_COLUMNS)
    )
    for row in first.collect():
        assert row.ema_12 == row.close and row.ema_26 == row.close and row.macd == 0.0
        assert row.rsi_14 is None and row.bollinger_upper == row.bollinger_lower == row.close


def test_constant_and_falling_closes(spark):
    start, span = datetime(2024, 1, 1), timedelta(seconds=59)
    rows = [bar("FLAT", "1m", start + timedelta(minutes=i), 7, span) for i in range(40)]
    rows += [bar("DOWN", "1m", start + timedelta(minutes=i), 100 - i, span) for i in range(40)]
    result = calculate_indicators(spark.createDataFrame(rows, GOLD_SOURCE_COLUMNS))
    rsi = {
        (row.symbol, row.rsi_14) for row in result.filter("rsi_14 is not null").select("symbol", "rsi_14").collect()
    }
    assert rsi == {("FLAT", 50.0), ("DOWN", 0.0)}


def test_golden_series(spark):
    gold = build_gold(spark.createDataFrame(golden_rows(), GOLD_SOURCE_COLUMNS))
    assert gold.columns == [*GOLD_COLUMNS, "event_date"]
    rows = gold.filter("interval = '1m'").orderBy("open_time").collect()
    assert gold.count() == 34 and len(rows) == 30
    last = rows[-1]
    assert last.rsi_14 == 100.0 and last.bollinger_middle == pytest.approx(20.5, abs=1e-6)
    assert last.ema_12 == pytest.approx(24.543291, abs=1e-6)
    assert last.ema_26 == pytest.approx(18.841594, abs=1e-6)
    assert last.macd == pytest.approx(5.701697, abs=1e-6)
    assert last.bollinger_upper == pytest.approx(32.032563, abs=1e-6)
    assert last.bollinger_lower == pytest.approx(8.967437, abs=1e-6)


@pytest.mark.parametrize(("alpha", "start"), [(2 / 13, 0), (0.9, 3), (0.01, 50), (1.0, 2)])
def test_ema_start_and_smoothing(walks, alpha, start):
    frame = ema(walks, "close", "average", alpha, start_index=start, chunk_seconds=9000)
    actual = frame.toPandas().sort_values(["symbol", "open_time"]).reset_index(drop=True)
    wanted = np.concatenate(
        [recursion(g["close"].to_numpy(), alpha, start) for _, g in actual.groupby("symbol")]
    )
    assert (actual["average"].isna() == np.isnan(wanted)).all()
    assert np.nanmax(np.abs(actual["average"] - wanted)) < 1e-9


def test_ema_of_a_null_start_is_null(spark):
    start, span = datetime(2024, 1, 1), timedelta(seconds=59)
    rows = [bar("A", "1m", start + timedelta(minutes=i), 5, span) for i in range(5)]
    frame = spark.createDataFrame(rows, GOLD_SOURCE_COLUMNS).withColumn(
        "close", F.when(F.col("open_time") > F.lit(start), F.col("close"))
    )
    assert {row.e for row in ema(frame, "close", "e", 0.5).collect()} == {None}
    for chunk_seconds in (None, 120):
        assert {row.ema_12 for row in with_indicators(frame, chunk_seconds).collect()} == {None}
    with pytest.raises(ValueError):
        ema(frame, "close", "e", 0.0)


def test_index_and_previous_value_cross_chunks(walks):
    frame = sequence_index(walks, "i", chunk_seconds=900)
    frame = previous_value(frame, "close", "p", chunk_seconds=900)
    actual = frame.toPandas().sort_values(["symbol", "open_time"]).reset_index(drop=True)
    assert (actual["i"] == actual.groupby("symbol").cumcount()).all()
    shifted = actual.groupby("symbol")["close"].shift()
    assert ((actual["p"] == shifted) | (actual["p"].isna() & shifted.isna())).all()


def test_no_window_spans_a_whole_series(walks):
    plan = calculate_indicators(walks)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if " Window [" in line]
    assert windows and all("_chunk" in line for line in windows)


def test_latest_by_key(spark):
    rows = [("A", 1, 1, "old"), ("A", 1, 2, "new"), ("B", 1, 1, "x"), ("B", 1, 1, "y")]
    frame = spark.createDataFrame(rows, "k string, t int, version int, id string")
    kept = latest_by_key(frame, ["k", "t"], ["version", "id"])
    assert sorted(row.id for row in kept.collect()) == ["new", "y"]
    assert kept.columns == frame.columns
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()
