"""Codecs, Raw envelopes, kline normalization, Bronze and Silver batch operators."""

import json
from datetime import UTC, datetime

import pytest
from candle_data import CANDLE
from pyspark.sql import functions as F
from pyspark.sql import types as SparkT

from candlelake.functions.candles import interval_seconds, key_part
from candlelake.functions.codecs import decode_payload, encode_payload, strip_header
from candlelake.operators.bronze import build_bronze_rejected, build_bronze_valid
from candlelake.operators.envelope import build_raw, candle_messages
from candlelake.operators.normalize import latest_candles, normalize_klines, parse_klines
from candlelake.operators.quality import apply_ohlcv_quality_rules, apply_silver_quality_rules
from candlelake.operators.silver import build_silver
from candlelake.schema import (
    BRONZE_COLUMNS,
    CANDLE_COLUMNS,
    CANDLE_CONTRACT,
    CANDLE_SCHEMA,
    KAFKA_RAW_SCHEMA,
    KINESIS_RAW_SCHEMA,
    SILVER_COLUMNS,
    SILVER_SCHEMA,
    contract_fields,
    contract_schema,
    project,
    read_contract,
)
from candlelake.sources.readers import kline_polls

# A kline row as the exchange answers it.
KLINE = [1700000000000, "10.0", "12.0", "9.0", "11.0", "42.0", 1700000059999, "450.0", 17, "20.0", "215.0", "0"]
STAMP = datetime(2024, 2, 1, 12, 30)


def candles(spark, *rows):
    return spark.createDataFrame([dict(CANDLE, **row) for row in rows], CANDLE_SCHEMA)


def test_contract(tmp_path):
    path = tmp_path / "candle.avsc"
    path.write_text(CANDLE_CONTRACT)
    assert contract_schema(read_contract(str(path))) == CANDLE_SCHEMA
    assert len(CANDLE_COLUMNS) == 17 and CANDLE_SCHEMA["open_time"].dataType == SparkT.TimestampType()
    added = json.loads(CANDLE_CONTRACT)
    added["fields"].append({"name": "venue", "type": ["null", "string"], "default": None})
    assert contract_fields(json.dumps(added))[-1] == ("venue", "string", True)
    added["fields"][-1]["type"] = "bytes"
    with pytest.raises(ValueError, match="venue"):
        contract_fields(json.dumps(added))


def test_strict_payloads(spark):
    good = bytes(encode_payload(candles(spark, {})).first().value)
    cases = [good, good + b" \n", b"not-json", b"", None, good[:-1], good + b"x", good + b"}", good + b"]", good + b"," + good]
    cases += [good + good, b"[" + good + b"]", good + b"]}", good + b"}]", b'"' + good, good + b',"a":1}']
    frame = spark.createDataFrame(list(enumerate(cases)), "id int, value binary")
    strict = {r.id for r in decode_payload(frame, strict=True).collect() if r.data is not None}
    assert strict == {0, 1}
    lenient = {r.id for r in decode_payload(frame).collect() if r.data is not None}
    assert {0, 1, 6, 7, 8} <= lenient and not {2, 3, 4} & lenient


def test_avro_is_an_explicit_choice(spark):
    """Without Spark's module the codec is an error, and so is strict decoding with it."""
    frame = spark.createDataFrame([(b"x",)], "value binary")
    with pytest.raises(ValueError, match="strict"):
        decode_payload(frame, codec="avro", strict=True)
    try:
        decoded = decode_payload(frame, codec="avro")
    except Exception as error:  # noqa: BLE001
        assert "avro" in str(error).lower()
    else:
        assert decoded.columns == ["value", "data"]


def test_json_payloads(spark):
    frame = candles(spark, {})
    sent = encode_payload(frame, codec="json", schema_id=3).select("value")
    assert decode_payload(sent, codec="json", confluent_header=True).select("data.*").collect() == frame.collect()
    broken = spark.createDataFrame([(b'{"event_id":"x"}',), (b"[]",), (b"nonsense",), (None,)], "value binary")
    assert decode_payload(broken, codec="json").filter("data is not null").count() == 0
    with pytest.raises(ValueError):
        decode_payload(broken, codec="xml")


def test_payload_is_decoded_once_per_row(spark):
    sent = spark.createDataFrame([(b"{}",)], "value binary")
    valid = build_bronze_valid(decode_payload(sent, codec="json"))
    assert valid._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_header(spark):
    frame = spark.createDataFrame([(b"\x00\x00\x00\x00\x01abc",), (b"\x01\x00\x00\x00\x01abc",), (b"abc",)], "value binary")
    assert [bytes(r[0]) for r in frame.select(strip_header("value")).collect()] == [b"abc", b"abc", b""]
    checked = [r[0] and bytes(r[0]) for r in frame.select(strip_header("value", check_magic=True)).collect()]
    assert checked == [b"abc", None, None]


@pytest.mark.parametrize(
    ("key", "parts"),
    [(None, ("_unknown", "_unknown")), ("", ("", "_unknown")), ("A", ("A", "_unknown")), ("A|1m", ("A", "1m")), ("A|1m|x", ("A", "1m"))],
)
def test_key_parts(spark, key, parts):
    frame = spark.createDataFrame([(key,)], "k string")
    assert tuple(frame.select(key_part("k", 0), key_part("k", 1)).first()) == parts


@pytest.mark.parametrize(("label", "seconds"), [("1s", 1), ("15m", 900), ("4h", 14400), ("1M", 2592000), ("x", 1), ("", 1), (None, 1), ("0m", 1)])
def test_interval_seconds(spark, label, seconds):
    assert spark.createDataFrame([(label,)], "i string").select(interval_seconds("i")).first()[0] == seconds


def test_raw_envelopes(spark):
    payload = bytes(encode_payload(candles(spark, {})).first().value)
    kafka = spark.createDataFrame(
        [(b"BTCUSDC|1m", b"\x00\x00\x00\x00\x01" + payload, "t", 0, 5, STAMP, 1), (None, b"bad", "t", 0, 6, STAMP, 1)],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int",
    )
    raw = build_raw(kafka, "kafka", ingested_at=F.lit(STAMP))
    assert raw.columns == KAFKA_RAW_SCHEMA.fieldNames()
    good, bad = raw.orderBy("offset").collect()
    assert (good.symbol, good.interval, good.is_avro_decodable, good.ingestion_hour) == ("BTCUSDC", "1m", True, 12)
    assert (bad.symbol, bad.is_avro_decodable, bad.key, bad.source) == ("_unknown", False, None, "kafka")
    kinesis = spark.createDataFrame(
        [(payload, "BTCUSDC|1m", "1", STAMP)],
        "data binary, partitionKey string, sequenceNumber string, approximateArrivalTimestamp timestamp",
    )
    raw = build_raw(kinesis, "kinesis", stream_name="s", ingested_at=F.lit(STAMP))
    assert raw.columns == KINESIS_RAW_SCHEMA.fieldNames()
    row = raw.first()
    assert bytes(row.value) == payload and row.payload_size_bytes == len(payload) and row.is_avro_decodable
    with pytest.raises(ValueError):
        build_raw(kinesis, "kinesis")
    with pytest.raises(ValueError):
        build_raw(kinesis, "pulsar")


def test_candle_messages_send_an_event_once(spark):
    messages = candle_messages(candles(spark, {}, {}, {"event_id": "other"}))
    assert messages.columns == ["key", "value"]
    assert [r.key for r in messages.collect()] == ["BTCUSDC|1m"] * 2


def test_kline_normalization(spark):
    frame = spark.createDataFrame([("BTCUSDC", "1m", [str(v) for v in KLINE])], "symbol string, interval string, kline array<string>")
    row = normalize_klines(frame, now_ms=F.lit(1700000060000)).first()
    assert row.asDict() == dict(CANDLE, open_time=datetime(2023, 11, 14, 22, 13, 20), close_time=datetime(2023, 11, 14, 22, 14, 19, 999000), ingested_at=datetime(2023, 11, 14, 22, 14, 20))
    broken = spark.createDataFrame([("B", "1m", ["1", "x"])], "symbol string, interval string, kline array<string>")
    row = normalize_klines(broken, now_ms=F.lit(0)).first()
    assert row.open is None and row.close is None and row.close_time is None


def test_latest_closed_kline(spark):
    first, second = list(KLINE), [KLINE[0] + 60000, *KLINE[1:6], KLINE[6] + 60000, *KLINE[7:]]
    body = json.dumps([first, second])
    polls = spark.createDataFrame([("B", "1m", body), ("C", "1m", "[]"), ("D", "1m", '{"code":1}')], "symbol string, interval string, body string")
    middle = latest_candles(polls, now_ms=F.lit(KLINE[6] + 1)).collect()
    assert [(r.symbol, r.is_closed, r.event_id) for r in middle] == [("B", True, "binance:B:1m:1700000000000")]
    early = latest_candles(polls, now_ms=F.lit(0)).collect()
    assert [(r.is_closed, r.event_id) for r in early] == [(False, "binance:B:1m:1700000060000")]
    assert parse_klines(polls).filter("klines is null").count() == 1


def test_bronze_batch(spark):
    sent = encode_payload(candles(spark, {}, {}, {"event_id": "e2"})).select("value").withColumn("topic", F.lit("t"))
    bad = spark.createDataFrame([(b"bad", "t")], "value binary, topic string")
    decoded = decode_payload(sent.unionByName(bad))
    valid = build_bronze_valid(decoded, watermark_delay="2 days")
    assert valid.columns == BRONZE_COLUMNS and valid.count() == 2
    assert {(r.year, r.month, r.day, str(r.event_date)) for r in valid.collect()} == {(2023, 11, 14, "2023-11-14")}
    rejected = build_bronze_rejected(decoded)
    assert rejected.columns == ["topic", "value", "bronze_error_reason"]
    assert [(bytes(r.value), r.bronze_error_reason) for r in rejected.collect()] == [(b"bad", "avro_decode_failed")]
    assert decoded.filter("data is not null").count() + rejected.count() == decoded.count()


def test_bronze_keeps_the_closed_version_when_asked(spark):
    both = encode_payload(candles(spark, {"is_closed": False}, {})).select("value")
    decoded = decode_payload(both)
    assert build_bronze_valid(decoded).count() == 1
    assert build_bronze_valid(decoded, dedup_key=("event_id", "open_time", "is_closed")).count() == 2


def test_rejected_keeps_the_envelope(spark):
    frame = spark.createDataFrame(
        [("kinesis", "market-candles", "BTCUSDC|1m", "1", "bad", None)],
        "source string, stream_name string, partition_key string, sequence_number string, value string, data string",
    )
    row = build_bronze_rejected(frame).first()
    assert (row.stream_name, row.partition_key, row.bronze_error_reason) == ("market-candles", "BTCUSDC|1m", "avro_decode_failed")


def silver_input(spark, *rows):
    day = datetime(2023, 11, 14, tzinfo=UTC).date()
    return spark.createDataFrame([dict(CANDLE, event_date=day, **row) for row in rows], SILVER_SCHEMA)


@pytest.mark.parametrize(
    "defect",
    [{"open": -1.0}, {"low": 0.0}, {"high": 10.5}, {"low": 10.5}, {"close": 13.0}, {"volume": -1.0}, {"number_of_trades": -1}, {"close": None}, {"volume": None}, {"source": None}, {"is_closed": False}, {"is_closed": None}, {"ingested_at": None}, {"taker_buy_quote_asset_volume": -0.1}],
)
def test_quality_rules(spark, defect):
    row = {name: value for name, value in defect.items()}
    frame = spark.createDataFrame(
        [dict(CANDLE, event_date=datetime(2023, 11, 14).date()), {**CANDLE, "event_date": datetime(2023, 11, 14).date(), **row, "event_id": "bad"}],
        SILVER_SCHEMA,
    )
    assert [r.event_id for r in apply_silver_quality_rules(frame).collect()] == [CANDLE["event_id"]]


def test_nan_passes_unless_rejected(spark):
    nan = float("nan")
    frame = spark.createDataFrame([{**CANDLE, "event_date": datetime(2023, 11, 14).date(), "volume": nan}], SILVER_SCHEMA)
    assert apply_ohlcv_quality_rules(frame).count() == 1
    assert apply_ohlcv_quality_rules(frame, reject_nan=True).count() == 0


def test_silver_keeps_the_newest_version(spark):
    base = dict(CANDLE, event_date=datetime(2023, 11, 14).date())
    later = datetime(2024, 1, 1, tzinfo=UTC)
    rows = [base, {**base, "ingested_at": later, "event_id": "a"}, {**base, "ingested_at": later, "event_id": "b"}]
    silver = build_silver(spark.createDataFrame(rows, SILVER_SCHEMA))
    assert silver.columns == SILVER_COLUMNS and [r.event_id for r in silver.collect()] == ["b"]
    with pytest.raises(ValueError, match="missing columns: nope"):
        project(silver, ["nope"])


def test_klines_from_landed_answers(spark, tmp_path):
    """Answers landed as JSON lines, through the file reader to normalized candles."""
    lines = [
        {"symbol": "BTCUSDC", "interval": "1m", "polled_at_ms": 1700000060000, "body": json.dumps([KLINE, [KLINE[0] + 60000, *KLINE[1:6], KLINE[6] + 60000, *KLINE[7:]]])},
        {"symbol": "ETHUSDC", "interval": "1m", "polled_at_ms": 1700000060000, "body": "[]"},
    ]
    (tmp_path / "polls.json").write_text("\n".join(map(json.dumps, lines)))
    polls = kline_polls(spark, str(tmp_path))
    assert polls.count() == 2
    rows = parse_klines(polls).select("symbol", "interval", "polled_at_ms", F.explode("klines").alias("kline"))
    candles = normalize_klines(rows, now_ms=F.col("polled_at_ms")).orderBy("open_time").collect()
    assert [(c.symbol, c.is_closed, c.close) for c in candles] == [("BTCUSDC", True, 11.0), ("BTCUSDC", False, 11.0)]
