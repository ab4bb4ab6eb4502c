"""Bronze layer: decoded records, split into valid candles and rejected envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.operators.scan import first_by
from candlelake.schema import ENVELOPE_COLUMNS

# Fixed value: reason written next to a rejected envelope.
DECODE_FAILED = "avro_decode_failed"

# event_id contains the open time, so the pair identifies the same events as event_id alone, and with
# the watermarked column in the key Spark can drop state it no longer needs.
DEDUP_KEY = ("event_id", "open_time")

# Envelope columns that tell copies of one event apart.
_COPY_COLUMNS = ("topic", "partition", "offset", "stream_name", "sequence_number", "ingested_at")
_SPREAD = "_spread"
_POSITION = "_position"


def calendar_columns(frame: DataFrame, time: str = "open_time") -> DataFrame:
    return frame.withColumns(
        {
            "event_date": F.to_date(time),
            "year": F.year(time),
            "month": F.month(time),
            "day": F.dayofmonth(time),
        }
    )


def deduplicate(
    frame: DataFrame,
    keys: Sequence[str],
    *,
    spread_column: str | None = None,
    within_watermark: bool = False,
    position: str | None = None,
) -> DataFrame:
    """One row per key: in a stream the first seen, in a batch the first ingested.

    With ``spread_column`` a stream first drops copies within each value of that column and then
    across them, so one event with very many copies is not the work of one task. A batch needs no such
    step: each task drops its copies before the shuffle. Rows of a batch ingested at the same time are
    told apart by ``position``, a column that tells copies apart and is dropped, or else by their content; so a
    recomputed task picks the same one.
    """
    if not frame.isStreaming:
        rest = [position] if position else [name for name in frame.columns if name not in (*keys, "ingested_at")]
        first = first_by(frame, keys, [F.col(name) for name in ("ingested_at", *rest)])
        return first.drop(position) if position else first
    drop = DataFrame.dropDuplicatesWithinWatermark if within_watermark else DataFrame.dropDuplicates
    if spread_column is not None:
        frame = drop(frame, [*keys, spread_column]).drop(spread_column)
    return drop(frame, list(keys))


def build_bronze_valid(
    decoded: DataFrame,
    *,
    watermark_delay: str | None = None,
    dedup_key: Sequence[str] = DEDUP_KEY,
    spread: int = 8,
    within_watermark: bool = False,
) -> DataFrame:
    """Decoded candles with calendar columns, one row per event; for batches and streams alike.

    In a stream, rows later than the watermark are dropped. ``dedup_key`` may add ``is_closed``, so that
    a candle seen before its close does not hide its closed version. ``spread`` is the number of tasks
    the copies of one event are divided over.
    """
    kept = decoded.filter(F.col("data").isNotNull())
    copies = [F.col(name) for name in _COPY_COLUMNS if name in decoded.columns]
    spread_column = _SPREAD if kept.isStreaming and spread > 1 and copies else None
    position = _POSITION if copies and not kept.isStreaming else None
    extra = [F.pmod(F.xxhash64(*copies), F.lit(spread)).alias(_SPREAD)] if spread_column else []
    extra += [F.struct(*copies).alias(_POSITION)] if position else []
    valid = calendar_columns(kept.select("data.*", *extra))
    if watermark_delay and valid.isStreaming:
        valid = valid.withWatermark("open_time", watermark_delay)
    return deduplicate(
        valid,
        dedup_key,
        spread_column=spread_column,
        within_watermark=within_watermark,
        position=position,
    )


def build_bronze_final(
    decoded: DataFrame, *, watermark_delay: str | None = None, dedup_key: Sequence[str] = DEDUP_KEY
) -> DataFrame:
    """Decoded candles, one row per event, of which a closed version counts before an open one; else the first ingested.

    In a stream an event is written once, when the watermark has passed it: later than by ``build_bronze_valid``, but no
    open candle hides its closed version. Each event is one row of state until then, and copies are reduced to one in
    every task before the shuffle. In a batch both give one row per event at once.
    """
    if not decoded.isStreaming:
        kept = decoded.filter(F.col("data").isNotNull())
        copies = [F.col(name) for name in _COPY_COLUMNS if name in decoded.columns]
        rows = calendar_columns(kept.select("data.*", F.struct(*copies).alias(_POSITION) if copies else F.lit(0).alias(_POSITION)))
        return first_by(rows, dedup_key, [F.col("is_closed").desc_nulls_last(), F.col("ingested_at"), F.col(_POSITION)]).drop(_POSITION)
    if watermark_delay is None or "open_time" not in dedup_key:
        raise ValueError("a stream needs a watermark delay, and open_time in its key, to know when an event is final")
    rows = decoded.filter(F.col("data").isNotNull()).select("data.*").withWatermark("open_time", watermark_delay)
    names = rows.columns
    # The greatest of these is the closed one that was ingested first; the rest of the row decides between equals.
    rank = F.struct(F.coalesce("is_closed", F.lit(False)), -F.unix_micros("ingested_at"), *[F.col(n) for n in names if n not in dedup_key])
    best = rows.groupBy(*dedup_key).agg(F.max_by(F.struct(*[n for n in names if n not in dedup_key]), rank).alias("_best"))
    return calendar_columns(best.select(*dedup_key, "_best.*").select(*names))


def build_bronze_rejected(decoded: DataFrame) -> DataFrame:
    """Envelopes whose payload did not decode, with every known envelope column they have."""
    kept = [name for name in ENVELOPE_COLUMNS if name in decoded.columns]
    return decoded.filter(F.col("data").isNull()).select(
        *kept, F.lit(DECODE_FAILED).alias("bronze_error_reason")
    )
