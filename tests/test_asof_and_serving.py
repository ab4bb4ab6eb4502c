"""As-of join against brute force, serving tables against the golden values, read-out queries."""

from datetime import datetime, timedelta

import pytest
from candle_data import PROCESSED_AT, golden_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from candlelake.functions.parameters import page_limit
from candlelake.operators.asof import asof_join
from candlelake.operators.indicators import ema
from candlelake.operators.scan import chunk_seconds_by_density, previous_value, sequence_index, time_chunk
from candlelake.plans import restitution as R
from candlelake.plans.jobs import build_gold
from candlelake.plans.serving import (
    GOLD_VIEW,
    SERVING_TABLES,
    ServingContext,
    market_multitimeframe_signals,
    materialize_serving_tables,
    register_serving_views,
)
from candlelake.plans.templates import render_sql, run_template
from candlelake.schema import GOLD_SOURCE_COLUMNS

START = datetime(2024, 1, 1)
CONTEXT = ServingContext(processing_timestamp=PROCESSED_AT)


def at(seconds):
    return None if seconds is None else START + timedelta(seconds=seconds)


def brute_force(left, right):
    out = []
    for key, time, tag in left:
        seen = [r for r in right if r[0] == key and time is not None and r[1] is not None and r[1] <= time]
        best = max(seen, key=lambda r: (r[1], r[2] is not None, r[2] or 0), default=None)
        out.append((key, time, tag, best is not None, None if best is None else best[2]))
    return sorted(out, key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    left=st.lists(
        st.tuples(st.sampled_from("AB"), st.none() | st.integers(0, 400), st.integers(0, 3)), min_size=1, max_size=25
    ),
    right=st.lists(
        st.tuples(st.sampled_from("ABC"), st.integers(0, 400), st.none() | st.floats(0, 9)),
        max_size=25,
        unique_by=lambda r: (r[0], r[1]),
    ),
    spread=st.sampled_from([1, 3]),
)
def test_asof_join_equals_brute_force(spark, left, right, spread):
    frame = spark.createDataFrame([(k, at(t), n) for k, t, n in left], "k string, t timestamp, n int")
    other = spark.createDataFrame([(k, at(t), v) for k, t, v in right], "k string, u timestamp, v double")
    joined = asof_join(
        frame, other, by=["k"], left_on="t", right_on="u", columns=["v"], chunk_seconds=60, spread=spread
    )
    actual = [
        (row.k, None if row.t is None else int((row.t - START).total_seconds()), row.n, row.match is not None,
         None if row.match is None else row.match.v)
        for row in joined.collect()
    ]
    assert sorted(actual, key=str) == brute_force(left, right)


@pytest.fixture(scope="module")
def gold(spark):
    return build_gold(spark.createDataFrame(golden_rows(), GOLD_SOURCE_COLUMNS)).cache()


@pytest.fixture(scope="module")
def tables(gold):
    return {table.name: frame.cache() for table, frame in materialize_serving_tables(gold, CONTEXT)}


def test_registry():
    assert [(t.name, t.partition_columns) for t in SERVING_TABLES] == [
        ("market_indicators", ("event_date", "symbol", "interval")),
        ("market_indicators_latest", ()),
        ("market_multitimeframe_signals", ()),
        ("market_daily_summary", ("event_date", "symbol")),
    ]
    with pytest.raises(ValueError, match="exactly two values"):
        ServingContext(context_intervals=("15m",))


def test_history_and_latest(tables):
    history = tables["market_indicators"]
    assert history.count() == 34
    assert {row.loaded_at for row in history.collect()} == {PROCESSED_AT}
    latest = tables["market_indicators_latest"].filter("interval = '1m'").collect()
    assert len(latest) == 1 and latest[0].open_time == datetime(2025, 1, 1, 1, 29)
    assert latest[0].close == 30.0 and latest[0].macd == pytest.approx(5.701697, abs=1e-6)


def test_signals(tables):
    signals = tables["market_multitimeframe_signals"]
    assert signals.columns == R.SIGNAL_FIELDS and signals.count() == 30
    last = signals.orderBy(F.desc("open_time")).first()
    assert (last.trend_15m, last.trend_1h, last.signal_score, last.signal_label) == ("up", "up", 3, "bullish")
    assert last.rsi_14_15m == last.rsi_14_1h == 100.0
    assert last.macd_15m == pytest.approx(1.595442, abs=1e-6)
    assert last.macd_1h == pytest.approx(1.595442, abs=1e-6)
    first = signals.orderBy("open_time").first()
    # One bar per context so far: no move yet, so no RSI, but a match nevertheless.
    assert (first.trend_15m, first.macd_15m, first.rsi_14_15m, first.signal_score) == ("neutral", 0.0, None, 1)


def test_signals_without_context_and_matched_on_close(gold):
    alone = market_multitimeframe_signals(gold.filter("interval = '1m'"), CONTEXT)
    rows = alone.collect()
    assert len(rows) == 30 and {(r.trend_15m, r.trend_1h, r.macd_1h) for r in rows} == {("neutral", "neutral", None)}
    strict = ServingContext(processing_timestamp=PROCESSED_AT, match_on="close_time")
    last = market_multitimeframe_signals(gold, strict).orderBy(F.desc("open_time")).first()
    # The 15-minute and one-hour bars in progress at 01:29 do not count yet.
    assert (last.macd_15m, last.macd_1h, last.signal_score) == (0.0, 0.0, 1)


def test_duplicate_base_rows_stay(gold):
    doubled = gold.unionByName(gold.filter("interval = '1m'"))
    assert market_multitimeframe_signals(doubled, CONTEXT).count() == 60


def test_daily_summary(tables):
    (row,) = tables["market_daily_summary"].collect()
    assert (row.open_price, row.close_price, row.high_price, row.low_price) == (1.0, 30.0, 31.0, 0.0)
    assert row.daily_volume == 300.0 and row.avg_rsi_14 == 100.0
    assert row.avg_macd == pytest.approx(3.117728, abs=1e-6)
    assert row.volatility_score == pytest.approx(8.803408, abs=1e-6)


def test_daily_summary_of_one_bar(gold):
    context = ServingContext("1h", ("15m", "1m"), PROCESSED_AT)
    single = gold.filter("interval = '1h' and close = 200")
    (row,) = dict((t.name, f) for t, f in materialize_serving_tables(single, context))["market_daily_summary"].collect()
    assert row.volatility_score == 0.0


def test_latest_needs_no_sort(tables, gold):
    from candlelake.plans.serving import market_indicators_latest

    plan = market_indicators_latest(gold, CONTEXT)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_views_and_templates(spark, gold):
    names = register_serving_views(gold, CONTEXT)
    assert spark.table(names[0]).count() == 34
    sql = "SELECT count(*) AS n FROM {{source_view}} WHERE interval = :interval"
    assert run_template(spark, sql, {"source_view": GOLD_VIEW}, {"interval": "15m"}).first().n == 2
    assert render_sql("{{a}}-{{ b }}{{a}}", {"a": "{{b}}", "b": "2"}) == "{{b}}-2{{b}}"
    for text in ("SELECT {{missing}}", "SELECT {{a", "a}} b"):
        with pytest.raises(KeyError):
            render_sql(text, {"a": "1"})


def test_history_query(tables):
    history = tables["market_indicators"]
    rows = R.history_query(history, "BTCUSDC", "1m", start="2025-01-01T01:10:00Z", end="2025-01-01T02:19:00+01:00")
    assert [r.close for r in rows.collect()] == [float(c) for c in range(20, 10, -1)]
    assert rows.columns == R.HISTORY_FIELDS
    page = R.history_query(history, "BTCUSDC", "1m", limit=5).collect()
    following = R.history_query(history, "BTCUSDC", "1m", limit=5, before=str(page[-1].open_time)).collect()
    assert [r.close for r in page + following] == [float(c) for c in range(30, 20, -1)]
    first = R.history_query(history, "BTCUSDC", "1m", limit=5)
    assert R.next_before(first, 5) == str(page[-1].open_time) and R.next_before(first, 6) is None
    assert "TakeOrderedAndProject" in first._jdf.queryExecution().executedPlan().toString()
    assert R.history_query(history, "BTCUSDC", "1m").count() == 30


def long_history(spark, rows):
    moment = F.timestamp_seconds(F.lit(1735689600) + F.col("id") * 3600)
    columns = {c: F.lit(1.0) for c in R.HISTORY_FIELDS if c not in ("symbol", "interval", "open_time", "close_time", "event_date")}
    frame = spark.range(rows).select(F.lit("BTCUSDC").alias("symbol"), F.lit("1h").alias("interval"), moment.alias("open_time"))
    return frame.withColumns({**columns, "close_time": F.col("open_time"), "event_date": F.to_date("open_time")})


def test_no_row_is_dropped_without_a_limit(spark):
    assert R.history_query(long_history(spark, 700), "BTCUSDC", "1h").count() == 700


def test_bounds_in_another_zone_and_below_a_second(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Asia/Tokyo", "UTC"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            history = long_history(spark, 60)
            found = R.history_query(history, "BTCUSDC", "1h", start="2025-01-01T00:00:00Z", end="2025-01-01T09:00:00Z")
            assert found.count() == 10
            late = history.withColumn("open_time", F.timestamp_millis(F.unix_millis("open_time") + 500))
            assert R.history_query(late, "BTCUSDC", "1h", end="2025-01-01T09:00:00.9Z").count() == 10
            assert R.history_query(late, "BTCUSDC", "1h", end="2025-01-01T09:00:00.4Z").count() == 9
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_later_page_prunes_days(spark, tmp_path):
    path = str(tmp_path / "history")
    long_history(spark, 24 * 30).write.partitionBy("event_date").parquet(path)
    page = R.history_query(spark.read.parquet(path), "BTCUSDC", "1h", limit=50, before="2025-01-05 12:00:00")
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in plan.split("PartitionFilters:")[1].split("]")[0] and "2025-01-06" in plan
    assert page.count() == 50


@pytest.mark.parametrize("reverse", [False, True])
def test_asof_ties_do_not_depend_on_order(spark, reverse):
    rows = [("k", 10, 1, "a"), ("k", 10, 5, "a"), ("k", 10, 5, None), ("k", 10, None, "z"), ("k", 9, 9, "z")]
    rows = [(k, START + timedelta(seconds=t), v, w) for k, t, v, w in (rows[::-1] if reverse else rows)]
    right = spark.createDataFrame(rows, "k string, at timestamp, v int, w string").coalesce(1)
    left = spark.createDataFrame([("k", START + timedelta(seconds=s)) for s in (8, 9, 10, 500)], "k string, t timestamp")
    for chunk in (3, 100_000):
        joined = asof_join(left, right, by=["k"], left_on="t", right_on="at", columns=["v", "w"], chunk_seconds=chunk)
        got = [r.match and (r.match.v, r.match.w) for r in joined.orderBy("t").collect()]
        assert got == [None, (9, "z"), (5, "a"), (5, "a")]


def test_carries_over_many_chunks(spark):
    """Positions, previous values and averages over 3,000 chunks of one series, and over a second, shorter one."""
    rows = spark.range(3000).select(F.lit("S").alias("symbol"), F.lit("1s").alias("interval"), "id").unionByName(
        spark.range(7).select(F.lit(None).cast("string").alias("symbol"), F.lit("1s").alias("interval"), "id")
    )
    frame = rows.select("symbol", "interval", F.timestamp_seconds(F.col("id") * 10).alias("open_time"), F.timestamp_seconds(F.col("id") * 10 + 9).alias("close_time"), F.col("id").cast("double").alias("x"))
    found = previous_value(sequence_index(frame, chunk_seconds=10), "x", "before", chunk_seconds=10)
    for r in found.collect():
        assert r["_row_index"] == r.x and r.before == (None if r.x == 0 else r.x - 1)
    average, wanted = ema(frame, "x", "e", 0.5, chunk_seconds=10), 0.0
    got = {(r.symbol, r.x): r.e for r in average.collect()}
    for k in range(3000):
        wanted = 0.5 * k + 0.5 * wanted
        assert got[("S", float(k))] == pytest.approx(wanted)


def test_dense_rows_get_shorter_chunks(spark):
    dense = spark.range(400_000).select(F.lit("S").alias("symbol"), F.lit("1h").alias("interval"), F.timestamp_millis(F.col("id") * 10).alias("open_time"))
    seconds = chunk_seconds_by_density(dense)
    assert seconds < 700
    most = dense.groupBy(time_chunk("open_time", seconds)).count().agg(F.max("count")).first()[0]
    assert most <= 70_000


def test_signal_and_daily_queries(tables):
    signals = R.signals_query(tables["market_multitimeframe_signals"], "BTCUSDC", start="2025-01-01", limit=3)
    assert [r.close for r in signals.collect()] == [30.0, 29.0, 28.0]
    daily = tables["market_daily_summary"]
    assert R.daily_summary_query(daily, "BTCUSDC", start="2025-01-01", end="2025-01-01").count() == 1
    assert R.daily_summary_query(daily, "BTCUSDC", start="2025-01-02").count() == 0


@pytest.mark.parametrize(
    ("call", "message"),
    [
        (lambda t: R.history_query(t, None, "1m"), "'symbol': is needed"),
        (lambda t: R.history_query(t, "DOGE", "1m"), "'symbol': 'DOGE' is not served"),
        (lambda t: R.history_query(t, "BTCUSDC", "2m"), "'interval'"),
        (lambda t: page_limit(501), "limit"),
        (lambda t: page_limit("x"), "whole number"),
        (lambda t: page_limit(0), "limit"),
        (lambda t: R.history_query(t, "BTCUSDC", "1m", start="soon"), "ISO"),
        (lambda t: R.daily_summary_query(t, "BTCUSDC", start="2025-01-01T00:00"), "ISO date"),
    ],
)
def test_parameter_errors(tables, call, message):
    with pytest.raises(ValueError, match=message):
        call(tables["market_indicators"])


def test_snapshot(spark, tables):
    now = F.lit("2025-01-02 00:00:00").cast("timestamp")
    snapshot = R.latest_snapshot(tables["market_indicators_latest"], now=now)
    row = R.latest_metric(snapshot, "BTCUSDC", "1h")
    assert row["close"] == 220.0 and row["expires_at_epoch"] == 1735776000 + 7 * 86400
    with pytest.raises(LookupError):
        R.latest_metric(snapshot, "ETHUSDC", "1h")
    later = F.lit("2025-01-05 00:00:00").cast("timestamp")
    update = R.latest_snapshot(tables["market_indicators_latest"].filter("interval = '1m'"), now=later)
    merged = {r.interval: r.expires_at_epoch for r in R.merge_snapshot(snapshot, update, now=later).collect()}
    assert merged["1m"] - merged["1h"] == 3 * 86400 and len(merged) == 3
    expired = F.lit("2025-02-05 00:00:00").cast("timestamp")
    assert R.merge_snapshot(snapshot, update, now=expired).count() == 1
