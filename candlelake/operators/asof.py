"""As-of joins: for each row, the latest matching row at or before its time.

Both sides meet in one shuffle by key and time chunk, where the latest right row is carried along a
window. What a chunk needs from before its start comes from one summary row per chunk (see ``scan``),
so a key with very many rows is spread over its chunks and no row meets more than one partner.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.operators.chunks import Chunks, measured_chunks
from candlelake.operators.scan import CARRY, CHUNK, PART, RANK, SPLITS, carry_forward, time_chunk

_TIME = "_time"
_SPREAD = "_spread"
_LEFT_RANK = 1


def _fill_forward(
    rows: DataFrame, by: Sequence[str], names: Sequence[str], chunk_seconds: Chunks | Column | int | None, spread: int | None
) -> DataFrame:
    """Left rows with the latest struct of each match column at or before their ``_time``.

    ``rows`` holds left rows (``_rank`` 1) and right rows (``_rank`` 0), each right row with one struct
    per match it takes part in. The left rows of a chunk of several ``_splits`` are divided over that many tasks, and its
    right rows are repeated for each; ``spread`` does so in every chunk.
    """
    if spread is not None and spread < 1:
        raise ValueError("spread must be at least 1")
    left_columns = [name for name in rows.columns if name not in (*names, RANK)]
    chunks = measured_chunks(rows, by, _TIME) if chunk_seconds is None else chunk_seconds
    if isinstance(chunks, Chunks):
        chunked, divided = chunks.number(rows, _TIME), chunks.split
    else:
        chunked, divided = rows.withColumns({CHUNK: time_chunk(_TIME, chunks), SPLITS: F.lit(1)}), None
    if spread is not None:
        chunked, divided = chunked.withColumn(SPLITS, F.lit(spread)), None
    in_parts = divided is not None or (spread or 1) > 1

    # Of right rows at one moment the greatest struct counts, here and in the window below.
    def latest(name: str) -> Column:
        known = F.when(F.col(name).isNotNull(), F.struct(F.col(_TIME), F.col(name).alias("picked")))
        return F.max(known)["picked"].alias(name)

    parts = chunked.groupBy(*by, CHUNK).agg(F.struct(*[latest(name) for name in names]).alias(PART))

    def later(a: Column, b: Column) -> Column:
        return F.struct(*[F.coalesce(b[name], a[name]).alias(name) for name in names])

    carries = carry_forward(parts, by, later).filter(F.col(CARRY).isNotNull())
    opening = carries.select(*by, CHUNK, F.lit(-1).alias(RANK), f"{CARRY}.*")
    if divided is None:
        opening = opening.withColumn(SPLITS, F.lit(spread or 1))
    else:
        opening = _with_splits(opening, divided, by)
    met = chunked.unionByName(opening, allowMissingColumns=True)
    keys = [*by, CHUNK]
    if in_parts:
        own = F.array(F.pmod(F.xxhash64(*left_columns), F.col(SPLITS)).cast("int"))
        every = F.sequence(F.lit(0), F.col(SPLITS) - 1)
        met = met.withColumn(
            _SPREAD, F.explode(F.when(F.col(RANK) == _LEFT_RANK, own).otherwise(every))
        )
        keys.append(_SPREAD)
    # NULL times sort first, so the carry row opens its chunk. A right row has the same struct for each match.
    window = (
        Window.partitionBy(*keys)
        .orderBy(F.col(_TIME), F.col(RANK), F.coalesce(*names))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        met.withColumns({name: F.last(name, ignorenulls=True).over(window) for name in names})
        .filter(F.col(RANK) == _LEFT_RANK)
        .drop(CHUNK, SPLITS, _SPREAD)
    )


def _with_splits(opening: DataFrame, divided: DataFrame, by: Sequence[str]) -> DataFrame:
    """Carry rows with the number of parts of their chunk."""
    parts = divided.select(*[F.col(name).alias(f"_of_{name}") for name in (*by, CHUNK)], F.col(SPLITS).alias("_of_splits"))
    same = F.lit(True)
    for name in (*by, CHUNK):
        same = same & F.col(name).eqNullSafe(F.col(f"_of_{name}"))
    return opening.join(parts, same, "left").select(*opening.columns, F.coalesce("_of_splits", F.lit(1)).alias(SPLITS))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    columns: Sequence[str],
    match: str = "match",
    chunk_seconds: Chunks | Column | int | None = None,
    spread: int | None = None,
) -> DataFrame:
    """Left rows with a struct of the right row's time and ``columns``, NULL where there is none.

    The right row is the latest of its key with ``right_on <= left_on``; of several at one moment, the one with the
    greatest ``columns``, compared in their order, NULL being the smallest. Left rows without a time match
    nothing. By default chunks are cut by counting the rows of both sides (``measured_chunks``, which runs at the call), and
    a moment with very many rows is divided over as many tasks as its rows need, with the right rows of just that chunk
    repeated. ``chunk_seconds`` is a fixed length instead, and ``spread`` a number of parts for every chunk.
    """
    picked = [F.col(right_on).alias(right_on), *[F.col(c) for c in columns if c != right_on]]
    left_rows = left.select("*", F.col(left_on).cast("timestamp").alias(_TIME), F.lit(_LEFT_RANK).alias(RANK))
    right_rows = right.filter(F.col(right_on).isNotNull()).select(
        *by,
        F.col(right_on).cast("timestamp").alias(_TIME),
        F.lit(0).alias(RANK),
        F.struct(*picked).alias(match),
    )
    rows = left_rows.unionByName(right_rows, allowMissingColumns=True)
    joined = _fill_forward(rows, by, [match], chunk_seconds, spread)
    return joined.select(
        *left.columns, F.when(F.col(left_on).isNotNull(), F.col(match)).alias(match)
    )


def asof_contexts(
    frame: DataFrame,
    *,
    by: Sequence[str],
    is_left: Column,
    time: str,
    contexts: Mapping[str, Column],
    columns: Sequence[str],
    context_time: str | None = None,
    chunk_seconds: Chunks | Column | int | None = None,
    spread: int | None = None,
) -> DataFrame:
    """As-of join of a frame with parts of itself, several at once, in one scan and one shuffle.

    Rows where ``is_left`` holds get one struct of ``columns`` per context, taken from the latest row of
    that context with ``context_time <= time``.
    """
    context_time = time if context_time is None else context_time
    left = frame.filter(is_left).select(
        "*", F.col(time).alias(_TIME), F.lit(_LEFT_RANK).alias(RANK)
    )
    any_context = F.lit(False)
    structs = {}
    for name, condition in contexts.items():
        any_context = any_context | condition
        structs[name] = F.when(condition, F.struct(*columns)).alias(name)
    right = frame.filter(any_context & F.col(context_time).isNotNull()).select(
        *by, F.col(context_time).alias(_TIME), F.lit(0).alias(RANK), *structs.values()
    )
    rows = left.unionByName(right, allowMissingColumns=True)
    joined = _fill_forward(rows, by, list(contexts), chunk_seconds, spread)
    known = F.col(time).isNotNull()
    return joined.select(
        *frame.columns, *[F.when(known, F.col(name)).alias(name) for name in contexts]
    )
