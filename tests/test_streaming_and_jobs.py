"""Streams over files, sinks, layer jobs and job parameters."""

from datetime import datetime, timedelta

import pytest
from candle_data import CANDLE, PROCESSED_AT, golden_rows
from pyspark.sql import functions as F

from candlelake.__main__ import main
from candlelake.config import JobConfig, under
from candlelake.functions.codecs import encode_payload
from candlelake.operators.bronze import calendar_columns
from candlelake.operators.envelope import build_raw, candle_messages
from candlelake.plans.jobs import (
    BatchConfig,
    build_gold,
    datamart_targets,
    run_batch,
    run_gold_table,
    run_projection,
    run_silver_table,
)
from candlelake.plans.serving import SERVING_TABLES, ServingContext, market_indicators_latest
from candlelake.schema import BRONZE_COLUMNS, BRONZE_SCHEMA, CANDLE_SCHEMA, GOLD_SOURCE_COLUMNS, KINESIS_RAW_SCHEMA
from candlelake.sources import readers, sinks
from candlelake.streaming.jobs import await_all, await_any, recent_late_rows, replay_bronze, start_bronze, start_raw, state_rows

START = datetime(2024, 1, 1)


def candle_at(hours, **changes):
    open_time = START + timedelta(hours=hours)
    return dict(
        CANDLE,
        event_id=f"binance:BTCUSDC:1m:{hours}",
        open_time=open_time,
        close_time=open_time + timedelta(seconds=59),
        **changes,
    )


def envelopes(spark, rows, sequence=0):
    sent = encode_payload(spark.createDataFrame(rows, CANDLE_SCHEMA)).select("value", "open_time")
    return sent.select(
        F.col("value").alias("data"),
        F.lit("BTCUSDC|1m").alias("partitionKey"),
        (F.monotonically_increasing_id() + sequence).cast("string").alias("sequenceNumber"),
        F.col("open_time").alias("approximateArrivalTimestamp"),
    )


def land(spark, folder, rows, sequence=0, garbage=0):
    frame = envelopes(spark, rows, sequence)
    for i in range(garbage):
        frame = frame.unionByName(frame.limit(1).withColumns({"data": F.encode(F.lit("bad"), "UTF-8"), "sequenceNumber": F.lit(f"g{i}")}))
    build_raw(frame, "kinesis", stream_name="s").write.mode("append").parquet(f"{folder}/raw")


def run_bronze(spark, folder, **options):
    queries = start_bronze(
        spark,
        f"{folder}/raw",
        KINESIS_RAW_SCHEMA,
        f"{folder}/bronze",
        f"{folder}/checkpoint",
        rejected_path=f"{folder}/rejected",
        available_now=True,
        **options,
    )
    await_all(queries)
    return queries


def bronze(spark, folder):
    return readers.parquet_dataset(spark, f"{folder}/bronze", BRONZE_SCHEMA)


def test_duplicates_across_batches_restart_and_rejects(spark, tmp_path):
    folder = str(tmp_path)
    land(spark, folder, [candle_at(h) for h in range(4)] + [candle_at(0)], garbage=1)
    run_bronze(spark, folder)
    assert bronze(spark, folder).count() == 4
    land(spark, folder, [candle_at(h) for h in range(2, 6)], sequence=100, garbage=2)
    run_bronze(spark, folder)
    rows = bronze(spark, folder)
    assert rows.select(*BRONZE_COLUMNS).count() == 6 == rows.select("event_id").distinct().count()
    rejected = spark.read.parquet(f"{folder}/rejected")
    assert rejected.count() == 3 and {r.bronze_error_reason for r in rejected.collect()} == {"avro_decode_failed"}
    # A replay reads the same Raw records as a batch and finds the same events.
    valid, invalid = replay_bronze(spark, f"{folder}/raw", KINESIS_RAW_SCHEMA)
    assert invalid.count() == 3
    assert {r.event_id for r in valid.collect()} == {r.event_id for r in rows.collect()}


@pytest.mark.parametrize("spread", [1, 4])
def test_late_rows_are_dropped_and_state_shrinks(spark, tmp_path, spread):
    folder = str(tmp_path)
    kept = []
    for phase, hours in enumerate(([0, 1], [100, 101], [200, 201], [5, 300])):
        land(spark, folder, [candle_at(h) for h in hours], sequence=phase * 1000)
        queries = run_bronze(spark, folder, watermark_delay="1 day", spread=spread)
        kept += hours
    assert sorted(r.event_id for r in bronze(spark, folder).collect()) == sorted(
        f"binance:BTCUSDC:1m:{h}" for h in kept if h != 5
    )
    # The last run dropped one row and forgot the events far behind its watermark.
    assert recent_late_rows(queries[0]) == 1
    assert 0 < state_rows(queries[0]) < 7 * (2 if spread > 1 else 1)


def test_rate_limited_bronze(spark, tmp_path):
    folder = str(tmp_path)
    for i in range(3):
        land(spark, folder, [candle_at(i)], sequence=i * 100)
    query = run_bronze(spark, folder, max_files_per_trigger=1)[0]
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) >= 3
    assert bronze(spark, folder).count() == 3


def test_raw_stream(spark, tmp_path):
    frame = envelopes(spark, [candle_at(h) for h in range(3)])
    frame.write.parquet(f"{tmp_path}/in")
    stream = readers.parquet_stream(spark, f"{tmp_path}/in", frame.schema)
    await_all([start_raw(stream, "kinesis", f"{tmp_path}/raw", f"{tmp_path}/ck", stream_name="s", available_now=True)])
    raw = readers.parquet_dataset(spark, f"{tmp_path}/raw", KINESIS_RAW_SCHEMA)
    assert raw.count() == 3 and {(r.symbol, r.interval, r.is_avro_decodable) for r in raw.collect()} == {("BTCUSDC", "1m", True)}
    assert (tmp_path / "ck" / "global").exists()


def test_bronze_needs_one_dead_letter_sink(spark, tmp_path):
    with pytest.raises(ValueError):
        start_bronze(spark, "r", KINESIS_RAW_SCHEMA, "b", "c")


def test_connector_options():
    kafka = readers.kafka_options("h:1", "t", maxOffsetsPerTrigger="5")
    assert kafka["startingOffsets"] == "earliest" and kafka["failOnDataLoss"] == "false" and kafka["subscribe"] == "t"
    kinesis = readers.kinesis_options("s", "r")
    assert kinesis == {"streamName": "s", "region": "r", "startingPosition": "TRIM_HORIZON"}
    assert sinks.kafka_sink_options("h:1", "t")["kafka.acks"] == "all"
    jdbc = sinks.jdbc_options("jdbc:x", "t", "u", "p", num_partitions=4, batch_size=1000)
    assert jdbc["dbtable"] == "public.t" and jdbc["truncate"] == "true" and jdbc["numPartitions"] == "4"
    assert sinks.jdbc_options("jdbc:x", "a.t", "u", "p")["dbtable"] == "a.t" and "batchsize" not in sinks.jdbc_options("x", "t", "u", "p")


def test_dynamic_overwrite_and_partition_pruning(spark, tmp_path):
    path = f"{tmp_path}/d"
    frame = spark.range(4).select("id", (F.col("id") % 2).cast("string").alias("p"))
    sinks.write_parquet_dataset(frame, path, ["p"])
    sinks.write_parquet_dataset(frame.filter("p = '1'").withColumn("id", F.col("id") + 10), path, ["p"], dynamic=True)
    stored = readers.parquet_dataset(spark, path, frame.schema)
    assert sorted(r.id for r in stored.collect()) == [0, 2, 11, 13]
    plan = stored.filter("p = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan


def bronze_candles(spark):
    silver = spark.createDataFrame(golden_rows(), GOLD_SOURCE_COLUMNS)
    filled = {
        "event_id": F.concat_ws(":", "symbol", "interval", F.unix_millis("open_time").cast("string")),
        "source": F.lit("test"),
        "low": F.greatest("low", F.lit(0.5)),
        "quote_asset_volume": F.col("volume"),
        "number_of_trades": F.lit(1).cast("bigint"),
        "taker_buy_base_asset_volume": F.col("volume"),
        "taker_buy_quote_asset_volume": F.col("volume"),
        "is_closed": F.lit(True),
        "ingested_at": F.col("close_time"),
    }
    return calendar_columns(silver.withColumns(filled)).select(*BRONZE_COLUMNS)


def test_batch_run(spark, tmp_path):
    layers = {
        "BRONZE_OUTPUT_PATH": "bronze",
        "SILVER_OUTPUT_PATH": "silver",
        "GOLD_OUTPUT_PATH": "gold",
        "TRADING_GOLD_OUTPUT_BASE_PATH": "serving",
        "LATEST_SNAPSHOT_PATH": "latest",
    }
    options = JobConfig.read((), {name: f"{tmp_path}/{layer}" for name, layer in layers.items()})
    config = BatchConfig.from_options(options)
    assert config.context == ServingContext()
    config = BatchConfig(config.paths, ServingContext(processing_timestamp=PROCESSED_AT))
    sinks.write_parquet_dataset(bronze_candles(spark), config.paths.bronze)
    run_batch(spark, config)
    run_batch(spark, config)
    assert spark.read.parquet(config.paths.gold).count() == 34
    signal = spark.read.parquet(f"{config.paths.serving}/market_multitimeframe_signals").orderBy(F.desc("open_time")).first()
    assert (signal.signal_score, signal.signal_label) == (3, "bullish")
    assert (tmp_path / "serving" / "market_daily_summary" / "event_date=2025-01-01" / "symbol=BTCUSDC").exists()
    snapshot = spark.read.parquet(config.paths.snapshot)
    assert snapshot.count() == 3 and "expires_at_epoch" in snapshot.columns


def test_projection_merges_into_the_stored_snapshot(spark, tmp_path):
    base, snapshot = str(tmp_path / "serving"), str(tmp_path / "latest")
    now = F.lit("2025-01-02 00:00:00").cast("timestamp")
    latest = ServingContext(processing_timestamp=PROCESSED_AT)
    gold = build_gold(spark.createDataFrame(golden_rows(), GOLD_SOURCE_COLUMNS))
    for kept, day in (("interval <> '1h'", 0), ("interval = '1h'", 1), ("interval = '1h'", 2)):
        table = market_indicators_latest(gold.filter(kept), latest)
        sinks.write_parquet_dataset(table, f"{base}/market_indicators_latest")
        run_projection(spark, base, snapshot, now=now + F.expr(f"INTERVAL {day} DAYS"))
    expiry = {r.interval: r.expires_at_epoch for r in spark.read.parquet(snapshot).collect()}
    assert set(expiry) == {"1m", "15m", "1h"} and expiry["1h"] - expiry["1m"] == 2 * 86400
    assert [p.name for p in tmp_path.iterdir() if ".new-" in p.name or ".old-" in p.name] == []


def test_a_failed_write_leaves_the_old_dataset(spark, tmp_path):
    path = str(tmp_path / "d")
    sinks.replace_parquet_dataset(spark.range(3), path)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        sinks.replace_parquet_dataset(broken, path)
    assert spark.read.parquet(path).count() == 3
    sinks.replace_parquet_dataset(spark.read.parquet(path).where("id > 0"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2]


def test_jobs_by_their_options(spark, tmp_path):
    """Bronze, Silver, Gold with serving tables, and the projection, each by its command line."""
    folder = str(tmp_path)
    land(spark, folder, [candle_at(h) for h in range(4)], garbage=1)
    words = {
        "bronze": f"--RAW_INPUT_PATH {folder}/raw --BRONZE_OUTPUT_PATH {folder}/b --BRONZE_CHECKPOINT_PATH={folder}/c "
        f"--BRONZE_REJECTED_OUTPUT_PATH {folder}/r --BRONZE_REJECTED_CHECKPOINT_PATH {folder}/rc --AVAILABLE_NOW true --CODEC json",
        "silver": f"--BRONZE_INPUT_PATH {folder}/b --SILVER_OUTPUT_PATH {folder}/s",
        "gold": f"--SILVER_INPUT_PATH {folder}/s --GOLD_OUTPUT_PATH {folder}/g --TRADING_GOLD_OUTPUT_BASE_PATH {folder}/t",
        "projection": f"--TRADING_GOLD_OUTPUT_BASE_PATH {folder}/t --LATEST_SNAPSHOT_PATH {folder}/l",
    }
    for job, options in words.items():
        main([job, *options.split()])
    assert {name: spark.read.parquet(f"{folder}/{name}").count() for name in ("b", "r", "s", "g", "l")} == {"b": 4, "r": 1, "s": 4, "g": 4, "l": 1}
    for table in SERVING_TABLES:
        assert spark.read.parquet(f"{folder}/t/{table.name}").count() > 0
    with pytest.raises(SystemExit, match="usage"):
        main(["nothing"])
    with pytest.raises(LookupError, match="SILVER_OUTPUT_PATH"):
        main(["silver", "--BRONZE_INPUT_PATH", folder])


def test_message_stream_forgets_events(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], CANDLE_SCHEMA).write.parquet(f"{folder}/in")
    stream = readers.parquet_stream(spark, f"{folder}/in", CANDLE_SCHEMA)
    with pytest.raises(ValueError, match="watermark"):
        candle_messages(stream)
    for hour in (0, 0, 100, 200, 300):
        spark.createDataFrame([candle_at(hour)], CANDLE_SCHEMA).write.mode("append").parquet(f"{folder}/in")
        sink = sinks.StreamSink.dataset(f"{folder}/out", f"{folder}/ck")
        query = sink.start(candle_messages(stream, watermark_delay="1 hour"), available_now=True)
        query.awaitTermination()
    assert spark.read.parquet(f"{folder}/out").count() == 4 and state_rows(query) < 4


def test_kinesis_rejects_have_a_key(spark):
    frame = spark.createDataFrame([("A|1m", b"x")], "partition_key string, value binary")
    assert sinks.keyed_messages(frame).first().key == "A|1m"


def test_catalog_tables(spark, tmp_path):
    bronze_candles(spark).write.parquet(f"{tmp_path}/bronze")
    run_silver_table(spark, f"{tmp_path}/bronze", "lake_silver", "market_candles")
    run_gold_table(spark, ("lake_silver", "market_candles"), ("lake_gold", "market_indicators"))
    assert readers.catalog_table(spark, "lake_gold", "market_indicators").count() == 34


def test_job_config():
    words = ("job", "--A", "1", "--B=x, y,,z", "--C=", "--F", "--G", "a b", "rest")
    config = JobConfig.read(words, {"A": "env", "D": "7"})
    assert config.text("A") == "1" and config.items("B") == ["x", "y", "z"] and config.text("G") == "a b"
    assert config.text("E", "fallback") == "fallback" and config.count("D", 1) == 7 and config.count("E", 3) == 3
    for name in ("C", "F", "MISSING"):
        with pytest.raises(LookupError, match=name):
            config.text(name)
    for name, most in (("D", 5), ("B", 5)):
        with pytest.raises(ValueError, match=name):
            config.count(name, 1, most)
    with pytest.raises(LookupError, match="DATAMART_INDICATORS_TABLE"):
        datamart_targets(config)
    assert under("/c/", "global") == "/c/global"


def test_timed_triggers_and_the_first_end(spark, tmp_path):
    """Two queries on a clock; when one is stopped, waiting for any ends and stops the other."""
    frame = spark.range(3)
    frame.write.parquet(f"{tmp_path}/in")
    queries = []
    for name in ("a", "b"):
        stream = readers.parquet_stream(spark, f"{tmp_path}/in", frame.schema)
        sink = sinks.StreamSink.dataset(f"{tmp_path}/{name}", f"{tmp_path}/ck_{name}", name=f"timed_{name}")
        queries.append(sink.start(stream, every="1 second"))
    for query in queries:
        query.processAllAvailable()
    spark.range(3, 5).write.mode("append").parquet(f"{tmp_path}/in")
    for query in queries:
        query.processAllAvailable()
    assert spark.read.parquet(f"{tmp_path}/a").count() == spark.read.parquet(f"{tmp_path}/b").count() == 5
    spark.streams.resetTerminated()
    queries[0].stop()
    await_any(spark, queries)
    assert not any(query.isActive for query in queries)
