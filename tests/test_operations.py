"""Compaction, ranged replay, closed versions, page tokens, and the jobs that start them."""

import base64
import os
from datetime import UTC, date, datetime, timedelta

import pytest
from candle_data import CANDLE, PROCESSED_AT, golden_rows
from pyspark.sql import functions as F
from test_streaming_and_jobs import bronze, candle_at, envelopes, land, run_bronze

from candlelake.__main__ import JOBS, main
from candlelake.config import JobConfig
from candlelake.operators.bronze import build_bronze_final
from candlelake.operators.envelope import build_raw
from candlelake.plans.jobs import build_gold, serving_context
from candlelake.plans.paging import read_page, read_token, write_token
from candlelake.plans.serving import ServingContext, market_indicators
from candlelake.schema import BRONZE_COLUMNS, BRONZE_PARTITIONS, CANDLE_SCHEMA, GOLD_SOURCE_COLUMNS, KINESIS_RAW_SCHEMA, RAW_PARTITIONS
from candlelake.sources.compaction import compact_raw, compacted_until, raw_dataset
from candlelake.streaming.jobs import replay_bronze, replay_bronze_days, state_rows

HOUR = datetime(2024, 5, 1, 9, tzinfo=UTC)


def raw_rows(spark, first, n, ingested):
    rows = envelopes(spark, [candle_at(first + k) for k in range(n)], first)
    return build_raw(rows, "kinesis", stream_name="s", ingested_at=F.lit(ingested).cast("timestamp"))


def parquet_files(folder):
    return [os.path.join(place, name) for place, _, names in os.walk(folder) for name in names if name.endswith(".parquet")]


def test_small_files_of_past_hours_become_few(spark, tmp_path):
    live, copy = f"{tmp_path}/raw", f"{tmp_path}/copy"
    for k in range(8):
        raw_rows(spark, 10 * k, 3, HOUR + timedelta(minutes=20 * k)).write.mode("append").partitionBy(*RAW_PARTITIONS).parquet(live)
    ids = lambda frame: sorted(r["sequence_number"] for r in frame.collect())
    wanted = ids(spark.read.parquet(live))
    read = lambda: ids(raw_dataset(spark, live, copy, KINESIS_RAW_SCHEMA))
    assert read() == wanted and compacted_until(spark, copy) is None
    # The hours 9 and 10 are over, 11 is not: three of its batches stay in the stream's folder.
    assert compact_raw(spark, live, copy, KINESIS_RAW_SCHEMA, HOUR + timedelta(hours=2, minutes=5)) == "2024-05-01 11"
    assert read() == wanted and len(parquet_files(copy)) == 2 and len(parquet_files(live)) >= 8
    # An hour that is copied already is not copied again; the mark moves once the next ones are.
    before = sorted(parquet_files(copy))
    assert compact_raw(spark, live, copy, KINESIS_RAW_SCHEMA, HOUR + timedelta(hours=1)) == "2024-05-01 11"
    assert sorted(parquet_files(copy)) == before
    main(["compact", "--RAW_INPUT_PATH", live, "--RAW_COMPACTED_PATH", copy, "--COMPACT_BEFORE", "2024-05-02T00:10:00"])
    assert compacted_until(spark, copy) == "2024-05-02 00" and read() == wanted and set(before) < set(parquet_files(copy))
    # Copied hours may go from the stream's folder.
    spark.createDataFrame([], KINESIS_RAW_SCHEMA).write.partitionBy(*RAW_PARTITIONS).mode("overwrite").parquet(live)
    assert read() == wanted


def test_a_failed_copy_is_not_seen(spark, tmp_path, monkeypatch):
    from candlelake.sources import compaction

    live, copy = f"{tmp_path}/raw", f"{tmp_path}/copy"
    raw_rows(spark, 0, 5, HOUR).write.partitionBy(*RAW_PARTITIONS).parquet(live)
    raw_rows(spark, 5, 5, HOUR + timedelta(hours=1)).write.mode("append").partitionBy(*RAW_PARTITIONS).parquet(live)
    compact_raw(spark, live, copy, KINESIS_RAW_SCHEMA, HOUR + timedelta(hours=1))

    def fails(*args):
        raise OSError("no rename")

    monkeypatch.setattr(compaction, "replace_mark", fails)
    with pytest.raises(OSError):
        compact_raw(spark, live, copy, KINESIS_RAW_SCHEMA, HOUR + timedelta(hours=2))
    monkeypatch.undo()
    assert raw_dataset(spark, live, copy, KINESIS_RAW_SCHEMA).count() == 10
    compact_raw(spark, live, copy, KINESIS_RAW_SCHEMA, HOUR + timedelta(hours=2))
    assert raw_dataset(spark, live, copy, KINESIS_RAW_SCHEMA).count() == 10


def test_replay_of_a_range_of_days_equals_a_full_replay(spark, tmp_path):
    live, target = f"{tmp_path}/raw", f"{tmp_path}/bronze"
    for day, first, n in ((0, 0, 30), (1, 20, 30), (2, 45, 30), (3, 70, 10)):
        raw_rows(spark, first, n, HOUR + timedelta(days=day)).write.mode("append").partitionBy(*RAW_PARTITIONS).parquet(live)
    day = lambda k: date(2024, 5, 1 + k)
    columns = [c for c in BRONZE_COLUMNS]
    show = lambda frame: sorted(map(str, frame.select(*columns).collect()))
    assert replay_bronze_days(spark, live, KINESIS_RAW_SCHEMA, target, day(0), day(1)) == 3
    before = set(parquet_files(target))
    # Replaying the same days finds nothing new; a further day rewrites only the partitions it adds to.
    assert replay_bronze_days(spark, live, KINESIS_RAW_SCHEMA, target, day(1), day(1)) == 0
    assert set(parquet_files(target)) == before
    assert replay_bronze_days(spark, live, KINESIS_RAW_SCHEMA, target, day(2), day(2)) == 2
    assert len(before & set(parquet_files(target))) == len(before) - 1
    main(["replay", "--RAW_INPUT_PATH", live, "--BRONZE_OUTPUT_PATH", target, "--REPLAY_FIRST_DAY", "2024-05-04",
          "--REPLAY_LAST_DAY", "2024-05-04", "--CODEC", "json"])
    assert show(spark.read.parquet(target)) == show(replay_bronze(spark, live, KINESIS_RAW_SCHEMA)[0])
    os.makedirs(f"{tmp_path}/owned/_spark_metadata")
    with pytest.raises(ValueError, match="belongs to a stream"):
        replay_bronze_days(spark, live, KINESIS_RAW_SCHEMA, f"{tmp_path}/owned", day(0), day(0))


def test_a_closed_version_counts_before_an_open_one(spark, tmp_path):
    folder = str(tmp_path)
    opened = [candle_at(h, is_closed=False, close=1.0) for h in range(4)]
    closed = [candle_at(h, close=2.0) for h in (0, 1, 2)] + [candle_at(1, close=3.0, ingested_at=CANDLE["ingested_at"] + timedelta(hours=1))]
    far = [candle_at(h) for h in (500, 501)]
    queries = []
    for phase, rows in enumerate((opened, closed, far, [candle_at(502)])):
        land(spark, folder, rows, sequence=phase * 1000)
        queries = run_bronze(spark, folder, watermark_delay="1 day", closed_wins=True)
    stored = {r.event_id.rpartition(":")[2]: (r.is_closed, r.close) for r in bronze(spark, folder).collect()}
    assert stored == {"0": (True, 2.0), "1": (True, 2.0), "2": (True, 2.0), "3": (False, 1.0)}
    # What is final has left the state; the last three events wait for the watermark.
    assert state_rows(queries[0]) == 3
    with pytest.raises(ValueError):
        build_bronze_final(spark.readStream.schema("data struct<open_time:timestamp>").json(f"{folder}/none*"))
    batch = spark.createDataFrame(opened + closed, CANDLE_SCHEMA).select(F.struct("*").alias("data"))
    assert {r.event_id.rpartition(":")[2]: r.close for r in build_bronze_final(batch).collect()} == {"0": 2.0, "1": 2.0, "2": 2.0, "3": 1.0}
    assert build_bronze_final(batch).columns == BRONZE_COLUMNS
    assert list(BRONZE_PARTITIONS) == ["event_date", "symbol", "interval"]


def test_pages_follow_from_their_tokens(spark):
    gold = build_gold(spark.createDataFrame(golden_rows(), GOLD_SOURCE_COLUMNS))
    history = market_indicators(gold, ServingContext(processing_timestamp=PROCESSED_AT)).cache()
    asked = {"symbol": "BTCUSDC", "interval": "1m", "start": "2025-01-01T01:03:00", "limit": 10}
    page = read_page("history", history, asked, secret="s")
    seen, sizes = [r.open_time.minute for r in page.rows], [len(page.rows)]
    while page.next_token:
        page = read_page("history", history, token=page.next_token, secret="s")
        seen += [r.open_time.minute for r in page.rows]
        sizes.append(len(page.rows))
    assert seen == list(range(29, 2, -1)) and sizes == [10, 10, 7]
    # A page that ends with the last row has no successor.
    assert read_page("history", history, {**asked, "limit": 27}).next_token is None

    token = write_token("history", asked, "2025-01-01 01:10:00", "s")
    assert read_token(token, "history", "s") == (asked, "2025-01-01 01:10:00")
    with pytest.raises(ValueError, match="for the query history"):
        read_page("signals", history, token=token, secret="s")
    with pytest.raises(ValueError, match="another interval"):
        read_page("history", history, {"interval": "1h"}, token, secret="s")
    changed = bytearray(base64.urlsafe_b64decode(token))
    changed[-5] ^= 1
    broken = (base64.urlsafe_b64encode(changed).decode(), token[:-4], "", "x", "?" * 8, "A" * 5000, write_token("history", asked, "b", "other"))
    for text in broken[:2] + broken[3:]:
        with pytest.raises(ValueError, match="not readable"):
            read_page("history", history, token=text, secret="s")
    with pytest.raises(ValueError, match="limit"):
        read_page("history", history, {"symbol": "BTCUSDC", "interval": "1m"})


def test_jobs_and_their_times():
    names = ["raw", "raw_kafka", "bronze", "bronze_kafka", "bronze_single", "compact", "replay"]
    names += ["silver", "silver_table", "gold", "gold_table", "datamart", "projection", "batch"]
    assert list(JOBS) == names
    context = serving_context(JobConfig({"PROCESSING_TIMESTAMP": "2025-01-02T03:00:00+02:00"}))
    assert context.processing_timestamp == datetime(2025, 1, 2, 1, tzinfo=UTC)
    assert serving_context(JobConfig({})).processing_timestamp is None
    with pytest.raises(ValueError, match="ISO"):
        serving_context(JobConfig({"PROCESSING_TIMESTAMP": "soon"}))


def test_table_and_batch_jobs(spark, tmp_path):
    folder = str(tmp_path)
    rows = [dict(candle_at(h), is_closed=True) for h in range(30)]
    land(spark, folder, rows)
    options = ["--BRONZE_OUTPUT_PATH", f"{folder}/bronze", "--CODEC", "json"]
    main(["bronze_single", "--RAW_INPUT_PATH", f"{folder}/raw", "--BRONZE_REJECTED_OUTPUT_PATH", f"{folder}/rejected",
          "--BRONZE_CHECKPOINT_PATH", f"{folder}/checkpoint", "--AVAILABLE_NOW", "true", *options])
    silver = ["--SILVER_DATABASE", "lake_s", "--SILVER_TABLE", "candles"]
    main(["silver_table", "--BRONZE_PATH", f"{folder}/bronze", *silver])
    main(["gold_table", *silver, "--GOLD_DATABASE", "lake_g", "--GOLD_TABLE", "indicators"])
    assert spark.table("lake_g.indicators").count() == 30
    paths = {"SILVER_OUTPUT_PATH": "silver", "GOLD_OUTPUT_PATH": "gold", "TRADING_GOLD_OUTPUT_BASE_PATH": "serving", "LATEST_SNAPSHOT_PATH": "latest"}
    given = [word for name, place in paths.items() for word in (f"--{name}", f"{folder}/{place}")]
    main(["batch", *options, *given, "--PROCESSING_TIMESTAMP", "2025-01-02T00:00:00"])
    row = spark.read.parquet(f"{folder}/latest").first()
    assert row.updated_at == datetime(2025, 1, 2) and row.expires_at_epoch == int(datetime(2025, 1, 9, tzinfo=UTC).timestamp())
    # The same layers by what changed, and the projection at a given time.
    state = ["--STATE_PATH", f"{folder}/state"]
    main(["silver", "--BRONZE_INPUT_PATH", f"{folder}/bronze", "--SILVER_OUTPUT_PATH", f"{folder}/silver", *state])
    main(["gold", "--SILVER_INPUT_PATH", f"{folder}/silver", "--GOLD_OUTPUT_PATH", f"{folder}/gold", *given[4:6], *state])
    assert spark.read.parquet(f"{folder}/gold").count() == 30
    main(["projection", *given[4:], "--PROCESSING_TIMESTAMP", "2025-01-05T00:00:00"])
    assert spark.read.parquet(f"{folder}/latest").first().expires_at_epoch == int(datetime(2025, 1, 12, tzinfo=UTC).timestamp())
