"""Ordered scans over series that may be far too long for one task.

A window over ``(symbol, interval)`` puts a whole series into one task, and one series may hold a third
of the data. The operators here cut every series into time chunks instead. Rows are shuffled by
``(series, chunk)``, each chunk is scanned on its own, and only one small summary per chunk travels
between chunks: ``carry_forward`` folds the summaries of all earlier chunks into a carry, which joins
the rows of its chunk as one more row at the front of their window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Protocol

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlelake.functions.candles import interval_seconds
from candlelake.schema import SERIES_KEY, SERIES_ORDER

CHUNK = "_chunk"
BLOCK = "_block"
PART = "_part"
GROUP = "_group"
CARRY = "_carry"
RANK = "_rank"
SPLITS = "_splits"

# A chunk spans as much time as this many candles of its interval take. The calendar bounds the number
# of chunks: a century of one-second candles has 48,000, whatever the number of rows.
CHUNK_CANDLES = 65536

# Chunks whose summaries are folded in one row.
GROUP_CHUNKS = 256


def default_chunk_seconds(by: Sequence[str]) -> Column:
    """Length of a chunk: from the interval label of the series, one-second candles where it has none."""
    spacing = interval_seconds("interval") if "interval" in by else F.lit(1)
    return spacing * CHUNK_CANDLES


def chunk_seconds_by_density(frame: DataFrame, by: Sequence[str] = SERIES_KEY, time: str = SERIES_ORDER[0]) -> int:
    """A length of chunks that holds about ``CHUNK_CANDLES`` rows of the densest series, whatever its label says.

    One aggregate over the series, whose result is one number; use it where rows lie closer than their interval.
    """
    seconds = F.unix_micros(F.col(time).cast("timestamp")) / 1e6
    spans = frame.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), (F.max(seconds) - F.min(seconds)).alias("span"))
    spacing = spans.where("n > 1 AND span > 0").agg(F.min(F.col("span") / F.col("n"))).first()[0]
    return max(1, int(CHUNK_CANDLES * spacing)) if spacing else CHUNK_CANDLES


def time_chunk(time: Column | str, chunk_seconds: Column | int) -> Column:
    """Number of the time chunk a row falls in, growing with time."""
    time = F.col(time) if isinstance(time, str) else time
    return F.floor(F.unix_seconds(time.cast("timestamp")) / chunk_seconds).cast("bigint")


class MeasuredChunks(Protocol):
    """Chunks by the count of rows, see ``chunks.measured_chunks``."""

    def number(self, frame: DataFrame, time: str) -> DataFrame: ...


#: Chunks of a series: measured, or of a length in seconds; None is by the interval label.
ChunkLength = MeasuredChunks | Column | int | None


def with_chunk(frame: DataFrame, by: Sequence[str], time: str, chunks: ChunkLength) -> DataFrame:
    """Add ``_chunk``; a row without a time has NULL, which is the first chunk of its series."""
    if chunks is None or isinstance(chunks, (Column, int)):
        return frame.withColumn(CHUNK, time_chunk(time, default_chunk_seconds(by) if chunks is None else chunks))
    return chunks.number(frame, time).drop(SPLITS)


def carry_forward(
    parts: DataFrame, by: Sequence[str], merge: Callable[[Column, Column], Column]
) -> DataFrame:
    """Exclusive ordered fold of one ``_part`` struct per ``(by, chunk)``.

    Returns ``(by, chunk, _carry)``, where the carry merges the parts of all earlier chunks of the
    series, NULL for the first. The fold has two levels: the chunks of a group are folded in one row, and so are
    the groups of a series; then each group is folded again from its carry. A group has ``GROUP_CHUNKS`` chunks
    at most, so the work grows with the number of chunks, and no row sees the rows of a series.
    """
    # The type as text has nullable fields throughout, which is what NULL carries need.
    part_type = parts.schema[PART].dataType.simpleString()
    join_parts, nothing = fold_step(merge, part_type), F.lit(None).cast(part_type)

    def entries(start: Column, label: str) -> Column:
        """From ``_items``: each label with the state before its part."""

        def step(acc: Column, item: Column) -> Column:
            entry = F.struct(item[label].alias(label), acc["state"].alias(CARRY))
            return F.struct(
                join_parts(acc["state"], item[PART]).alias("state"),
                F.concat(acc["entries"], F.array(entry)).alias("entries"),
            )

        none = F.array().cast(f"array<struct<{label}:bigint,{CARRY}:{part_type}>>")
        return F.aggregate("_items", F.struct(start.alias("state"), none.alias("entries")), step)["entries"]

    def items(frame: DataFrame, label: str, *keys: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct(label, PART)))
        return frame.groupBy(*by, *keys).agg(ordered.alias("_items"))

    grouped = parts.withColumn(GROUP, F.floor(F.col(CHUNK) / GROUP_CHUNKS).cast("bigint"))
    runs = items(grouped, CHUNK, GROUP)
    total = F.aggregate("_items", nothing, lambda acc, item: join_parts(acc, item[PART]))
    totals = runs.select(*by, GROUP, total.alias(PART))
    before = items(totals, GROUP).select(*by, F.inline(entries(nothing, GROUP)))
    named = before.toDF(*[f"_before_{name}" for name in by], "_before_group", "_entering")
    # Null-safe like the keys: rows without a time are a chunk of their own, and no branch filters what the other reads.
    same = F.col(GROUP).eqNullSafe(F.col("_before_group"))
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"_before_{name}"))
    return runs.join(named, same).select(*by, F.inline(entries(F.col("_entering"), CHUNK)))


def fold_step(
    merge: Callable[[Column, Column], Column], part_type: str
) -> Callable[[Column, Column], Column]:
    """``merge`` for a fold that starts from NULL."""
    return lambda acc, part: F.when(acc.isNull(), part).otherwise(merge(acc, part)).cast(part_type)


def series_window(by: Sequence[str], order: Sequence[str], *extra: str) -> WindowSpec:
    """Rows of a chunk in time order, the carry rows that travel with it first."""
    return Window.partitionBy(*by, CHUNK, *extra).orderBy(RANK, *order)


def with_carry_rows(rows: DataFrame, carries: DataFrame) -> DataFrame:
    """Rows and the carry rows of their chunks in one frame.

    A carry row has a negative ``_rank``, so it opens the window of its chunk and the rows read their
    carry from the front of the window: the wide side needs no join, only the shuffle it has anyway.
    """
    return rows.withColumn(RANK, F.lit(0)).unionByName(carries, allowMissingColumns=True)


def is_row() -> Column:
    return F.col(RANK) == 0


def sequence_index(
    frame: DataFrame,
    output: str = "_row_index",
    *,
    by: Sequence[str] = SERIES_KEY,
    order: Sequence[str] = SERIES_ORDER,
    chunk_seconds: ChunkLength = None,
) -> DataFrame:
    """Zero-based position of each row in its series."""
    chunked = with_chunk(frame, by, order[0], chunk_seconds)
    parts = chunked.groupBy(*by, CHUNK).agg(F.struct(F.count(F.lit(1)).alias("n")).alias(PART))
    carries = carry_forward(parts, by, lambda a, b: F.struct((a["n"] + b["n"]).alias("n"))).select(
        *by, CHUNK, F.lit(-1).alias(RANK), F.coalesce(f"{CARRY}.n", F.lit(0)).alias("_before")
    )
    window = series_window(by, order)
    # The carry row is number 1 of its chunk, so the first row is number 2.
    position = F.first("_before").over(window) + F.row_number().over(window) - 2
    return (
        with_carry_rows(chunked, carries)
        .withColumn(output, position)
        .filter(is_row())
        .select(*frame.columns, output)
    )


def previous_value(
    frame: DataFrame,
    source: str,
    output: str,
    *,
    by: Sequence[str] = SERIES_KEY,
    order: Sequence[str] = SERIES_ORDER,
    chunk_seconds: ChunkLength = None,
) -> DataFrame:
    """Value of ``source`` in the row before, NULL in the first row of a series."""
    chunked = with_chunk(frame, by, order[0], chunk_seconds)
    last = F.max_by(F.struct(F.col(source).alias("x")), F.struct(*order))
    parts = chunked.groupBy(*by, CHUNK).agg(last.alias(PART))
    carries = carry_forward(parts, by, lambda _, later: later).select(
        *by, CHUNK, F.lit(-1).alias(RANK), F.col(f"{CARRY}.x").alias(source)
    )
    return (
        with_carry_rows(chunked, carries)
        .withColumn(output, F.lag(source).over(series_window(by, order)))
        .filter(is_row())
        .select(*frame.columns, output)
    )


def first_by(frame: DataFrame, key_columns: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    Catalyst turns the ranking filter into a group limit below the shuffle, so a key with very many
    copies sends at most one row per task.
    """
    place = F.row_number().over(Window.partitionBy(*key_columns).orderBy(*order))
    return frame.select("*", place.alias("_place")).where("_place = 1").select(*frame.columns)


def latest_by_key(
    frame: DataFrame,
    key_columns: Sequence[str],
    order_columns: Sequence[str],
) -> DataFrame:
    """The row with the greatest order columns per key."""
    return first_by(frame, key_columns, [F.col(name).desc() for name in order_columns])
