"""Technical indicators: EMA, MACD, RSI and Bollinger bands.

All of them are ordered scans over a series, computed per time chunk with a carry (see ``scan``).
Inside a chunk an exponential average is a running sum of ``x / beta ** j``; since ``j`` restarts in
every block of ``BLOCK_ROWS`` rows, the powers stay far from overflow however long the series is. Between
blocks the average is one multiplication and one addition, which is what the carry holds.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.operators.scan import (
    BLOCK,
    CARRY,
    CHUNK,
    PART,
    RANK,
    ChunkLength,
    carry_forward,
    fold_step,
    is_row,
    sequence_index,
    series_window,
    with_carry_rows,
    with_chunk,
)
from candlelake.schema import GOLD_COLUMNS, SERIES_KEY, SERIES_ORDER

# Smoothing of EMA-12, EMA-26 and the 14-bar Wilder averages, Bollinger length and width.
ALPHA_12 = 2.0 / 13.0
ALPHA_26 = 2.0 / 27.0
ALPHA_WILDER = 1.0 / 14.0
BOLLINGER_ROWS = 20
BOLLINGER_WIDTH = 2.0

# beta ** -BLOCK_ROWS is at most e ** 171 for the three smoothings.
BLOCK_ROWS = 1024

TAIL_TYPE = "array<struct<j:int,x:double>>"
OPENING_RANK = -BOLLINGER_ROWS
_J = "_j"


def _power(alpha: float, exponent: Column) -> Column:
    return F.pow(F.lit(1.0 - alpha), exponent)


def _number_rows(
    chunked: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    block_rows: int,
    **along_chunk: Column,
) -> DataFrame:
    """Number the rows of each chunk: block within the chunk, and 1-based position within the block.

    Carry rows know their block and get position 0. ``along_chunk`` adds further window columns over the
    same sorted chunk.
    """
    carry_block = F.col(BLOCK) if BLOCK in chunked.columns else F.lit(None).cast("int")
    running = series_window(by, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = F.count(F.when(is_row(), 1)).over(running) - 1
    block = F.floor(F.col("_row") / block_rows).cast("int")
    position = (F.col("_row") % block_rows + 1).cast("int")
    return (
        chunked.withColumns({"_row": row, **along_chunk})
        .withColumns(
            {
                BLOCK: F.when(is_row(), block).otherwise(carry_block),
                _J: F.when(is_row(), position).otherwise(0),
            }
        )
        .drop("_row")
    )


def _blocks_of_chunks(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """The ``_items`` of each chunk: its blocks in order."""
    return parts.groupBy(*by, CHUNK).agg(F.array_sort(F.collect_list(F.struct(BLOCK, PART))).alias("_items"))


def _chunk_parts(parts: DataFrame, by: Sequence[str], merge: Callable[[Column, Column], Column]) -> DataFrame:
    """``(by, chunk, _part)``: the blocks of each chunk folded into one part."""
    part_type = parts.schema[PART].dataType.simpleString()
    join_parts, nothing = fold_step(merge, part_type), F.lit(None).cast(part_type)
    total = F.aggregate("_items", nothing, lambda acc, entry: join_parts(acc, entry[PART]))
    return _blocks_of_chunks(parts, by).select(*by, CHUNK, total.alias(PART))


def _block_carries(
    parts: DataFrame, by: Sequence[str], merge: Callable[[Column, Column], Column], before: DataFrame | None = None
) -> DataFrame:
    """``(by, chunk, block, _part, _carry)`` from one ``_part`` per ``(by, chunk, block)``.

    The blocks of a chunk are folded in one row; evenly spaced candles make at most
    ``CHUNK_CANDLES / BLOCK_ROWS`` of them. ``before`` has parts of earlier chunks, whose rows are not there.
    """
    part_type = parts.schema[PART].dataType.simpleString()
    # The keys are swapped on purpose: Spark keeps this small shuffle, and both uses of the parts below
    # read it instead of scanning the rows twice.
    parts = parts.repartition(CHUNK, *by)
    join_parts = fold_step(merge, part_type)
    nothing = F.lit(None).cast(part_type)
    totals = _chunk_parts(parts, by, merge)
    if before is not None:
        totals = totals.unionByName(before.select(*by, CHUNK, F.col(PART).cast(part_type).alias(PART)))
    carry = carry_forward(totals, by, merge)
    # The carry of a chunk joins its blocks as the item before block 0.
    entering = carry.filter(F.col(CARRY).isNotNull()).select(
        *by, CHUNK, F.lit(-1).alias(BLOCK), F.col(CARRY).alias(PART)
    )

    def with_block(acc: Column, entry: Column) -> Column:
        out = F.struct(entry[BLOCK].alias(BLOCK), entry[PART].alias(PART), acc["state"].alias(CARRY))
        return F.struct(
            join_parts(acc["state"], entry[PART]).alias("state"),
            F.concat(acc["out"], F.array(out)).alias("out"),
        )

    start = F.struct(
        nothing.alias("state"),
        F.array()
        .cast(f"array<struct<{BLOCK}:int,{PART}:{part_type},{CARRY}:{part_type}>>")
        .alias("out"),
    )
    return (
        _blocks_of_chunks(parts.select(*by, CHUNK, BLOCK, F.col(PART).cast(part_type).alias(PART)).union(entering), by)
        .select(*by, CHUNK, F.inline(F.aggregate("_items", start, with_block)["out"]))
        .filter(F.col(BLOCK) >= 0)
    )


def ema(
    frame: DataFrame,
    source: str,
    output: str,
    alpha: float,
    *,
    start_index: int = 0,
    by: Sequence[str] = SERIES_KEY,
    order: Sequence[str] = SERIES_ORDER,
    chunk_seconds: ChunkLength = None,
) -> DataFrame:
    """Exponential moving average of one column.

    The row at ``start_index`` takes its own value, every later row ``alpha * x + (1 - alpha) * previous``,
    and earlier rows are NULL. A NULL value counts as 0, a NULL start value makes the series NULL.
    """
    if not 0.0 < alpha <= 1.0:
        raise ValueError("alpha must be in (0, 1]")
    if start_index < 0:
        raise ValueError("start_index must not be negative")
    value = F.col(source).cast("double")
    keys = list(by)
    rows = frame.withColumn("_x", value)
    if start_index > 0:
        # Rows before the start become a series of their own, whose average is not shown.
        indexed = sequence_index(rows, "_index", by=by, order=order, chunk_seconds=chunk_seconds)
        rows = indexed.withColumn("_started", F.col("_index") >= start_index)
        keys.append("_started")
    chunked = with_chunk(rows, by, order[0], chunk_seconds)
    averaged = _ema_from_first_row(chunked, keys, order, alpha)
    shown = F.when(F.col("_started"), F.col("_ema")) if start_index > 0 else F.col("_ema")
    return averaged.select(*frame.columns, shown.alias(output))


def _ema_from_first_row(
    chunked: DataFrame, by: Sequence[str], order: Sequence[str], alpha: float
) -> DataFrame:
    """Add ``_ema``, the average of ``_x`` along each series."""
    if alpha == 1.0:
        return chunked.withColumn("_ema", F.col("_x"))
    # The smallest weight of a block, beta ** -block_rows, stays below e ** 300.
    block_rows = max(1, min(BLOCK_ROWS, int(300 / -math.log(1.0 - alpha))))
    decay = _power(alpha, F.col(_J))
    weighted = F.lit(alpha) * F.col("_x") / decay
    narrow = chunked.select(*by, CHUNK, *order, "_x", F.lit(0).alias(RANK))
    parts = (
        _number_rows(narrow, by, order, block_rows)
        .groupBy(*by, CHUNK, BLOCK)
        .agg(
            F.struct(
                F.max(_J).alias("n"),
                F.max_by("_x", -F.col(_J)).alias("first"),
                (F.coalesce(F.sum(weighted), F.lit(0.0)) * _power(alpha, F.max(_J))).alias("e"),
            ).alias(PART)
        )
    )

    def merge(a: Column, b: Column) -> Column:
        return F.struct(
            (a["n"] + b["n"]).alias("n"),
            a["first"].alias("first"),
            (a["e"] * _power(alpha, b["n"]) + b["e"]).alias("e"),
        )

    own, before = F.col(PART), F.col(CARRY)
    opens = before.isNull()
    start = F.when(opens, own["first"]).otherwise(before["first"] * _power(alpha, before["n"]) + before["e"])
    carries = _block_carries(parts, by, merge).select(
        *by,
        CHUNK,
        BLOCK,
        # The row that opens a series comes last of the carry rows, right before the first row.
        F.when(opens, F.lit(-1)).otherwise(F.lit(-2)).alias(RANK),
        start.alias("_start"),
    )
    previous = F.lag(RANK).over(series_window(by, order))
    rows = _number_rows(with_carry_rows(chunked, carries), by, order, block_rows, _first=previous == -1)
    running = series_window(by, order, BLOCK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    entered = F.when(is_row(), weighted).otherwise(F.col("_start"))
    void = F.max(~is_row() & F.col("_start").isNull()).over(running)
    average = F.coalesce(F.sum(entered).over(running), F.lit(0.0)) * decay
    return (
        rows.withColumns({"_void": void, "_ema": average})
        .filter(is_row())
        .withColumn(
            "_ema", F.when(F.col("_first"), F.col("_x")).when(~F.col("_void"), F.col("_ema"))
        )
    )


def _moves(delta: Column) -> tuple[Column, Column]:
    """Gain and loss of a price move; a missing move counts 0."""
    return F.greatest(delta, F.lit(0.0)), F.greatest(-delta, F.lit(0.0))


def _merge_parts(a: Column, b: Column) -> Column:
    """Part of two neighbouring runs of rows; the move between them joins the moves inside them."""
    n = b["n"]
    decay = _power(ALPHA_WILDER, n)
    gain, loss = _moves(b["first"] - a["last"])
    entry = decay * (ALPHA_WILDER / (1.0 - ALPHA_WILDER))
    tail = F.concat(a["tail"], b["tail"])
    return F.struct(
        (a["n"] + n).alias("n"),
        a["first"].alias("first"),
        b["last"].alias("last"),
        (a["e12"] * _power(ALPHA_12, n) + b["e12"]).alias("e12"),
        (a["e26"] * _power(ALPHA_26, n) + b["e26"]).alias("e26"),
        (a["gain"] * decay + gain * entry + b["gain"]).alias("gain"),
        (a["loss"] * decay + loss * entry + b["loss"]).alias("loss"),
        F.coalesce(a["first_gain"], gain).alias("first_gain"),
        F.coalesce(a["first_loss"], loss).alias("first_loss"),
        F.slice(
            tail, F.greatest(F.size(tail) - (BOLLINGER_ROWS - 2), F.lit(1)), BOLLINGER_ROWS - 1
        ).alias("tail"),
    )


def _scan_columns(close: Column, delta: Column) -> dict[str, Column]:
    """Weighted inputs of the four averages, and the decay of the row within its block."""
    gain, loss = _moves(delta)
    inside = F.col(_J) > 1
    row = F.col(_J) > 0
    p12, p26, pw = (_power(a, F.col(_J)) for a in (ALPHA_12, ALPHA_26, ALPHA_WILDER))
    return {
        "_p12": p12,
        "_p26": p26,
        "_pw": pw,
        "_w12": F.when(row, F.lit(ALPHA_12) * close / p12),
        "_w26": F.when(row, F.lit(ALPHA_26) * close / p26),
        "_wgain": F.when(inside, F.lit(ALPHA_WILDER) * gain / pw),
        "_wloss": F.when(inside, F.lit(ALPHA_WILDER) * loss / pw),
    }


def _indicator_parts(numbered: DataFrame) -> DataFrame:
    """Summary of each block: what later blocks need to know about it."""
    close, j = F.col("close"), F.col(_J)
    gain, loss = _moves(F.col("_delta"))
    rows = numbered.withColumns(_scan_columns(close, F.col("_delta")))
    # The last 19 rows of a block: of a full one by position, of the last one by what follows.
    in_tail = (j > BLOCK_ROWS + 1 - BOLLINGER_ROWS) | F.col("_ends")

    def total(weighted: str, alpha: float) -> Column:
        return F.coalesce(F.sum(weighted), F.lit(0.0)) * _power(alpha, F.max(_J))

    return rows.groupBy(*SERIES_KEY, CHUNK, BLOCK).agg(
        F.struct(
            F.max(_J).alias("n"),
            F.max_by("close", -j).alias("first"),
            F.max_by("close", j).alias("last"),
            total("_w12", ALPHA_12).alias("e12"),
            total("_w26", ALPHA_26).alias("e26"),
            total("_wgain", ALPHA_WILDER).alias("gain"),
            total("_wloss", ALPHA_WILDER).alias("loss"),
            F.max(F.when(j == 2, gain)).alias("first_gain"),
            F.max(F.when(j == 2, loss)).alias("first_loss"),
            F.array_sort(
                F.collect_list(F.when(in_tail, F.struct(j.alias("j"), close.alias("x"))))
            ).alias("tail"),
        ).alias(PART)
    )


def _carry_rows(carries: DataFrame) -> DataFrame:
    """Rows that open the blocks with their starting averages, and the up to 19 closes before a chunk."""
    own, before = F.col(PART), F.col(CARRY)
    opens = before.isNull()
    gain, loss = _moves(own["first"] - before["last"])

    def average(side: str, alpha: float) -> Column:
        seed = before["first"] * _power(alpha, before["n"])
        return F.when(opens, own["first"]).otherwise(seed + before[side])

    def wilder(side: str, move: Column) -> Column:
        first = f"first_{side}"
        previous = before[first] * _power(ALPHA_WILDER, before["n"] - 1) + before[side]
        at_first_row = (
            F.when(opens, own[first])
            .when(before["n"] == 1, move)
            .otherwise(F.lit(1.0 - ALPHA_WILDER) * previous + F.lit(ALPHA_WILDER) * move)
        )
        # Rows multiply by beta ** j, and the first row has j = 1.
        return at_first_row / F.lit(1.0 - ALPHA_WILDER)

    opening = F.struct(
        F.lit(OPENING_RANK).alias(RANK),
        F.lit(None).cast("double").alias("close"),
        average("e12", ALPHA_12).alias("_c12"),
        average("e26", ALPHA_26).alias("_c26"),
        wilder("gain", gain).alias("_cgain"),
        wilder("loss", loss).alias("_closs"),
    )
    nothing = [F.lit(None).cast("double").alias(f"_c{side}") for side in ("12", "26", "gain", "loss")]
    closes = F.transform(
        F.coalesce(F.when(F.col(BLOCK) == 0, before["tail"]), F.array().cast(TAIL_TYPE)),
        lambda item, position: F.struct(
            (position - F.size(before["tail"])).alias(RANK),
            item["x"].alias("close"),
            *nothing,
        ),
    )
    return carries.select(
        *SERIES_KEY, CHUNK, BLOCK, F.inline(F.concat(F.array(opening), closes))
    )


def _chunked_closes(frame: DataFrame, chunk_seconds: ChunkLength) -> DataFrame:
    closes = frame.withColumn("close", F.col("close").cast("double"))
    return with_chunk(closes, SERIES_KEY, SERIES_ORDER[0], chunk_seconds)


def _move() -> Column:
    return F.col("close") - F.lag("close").over(series_window(SERIES_KEY, SERIES_ORDER))


def indicator_blocks(frame: DataFrame, chunk_seconds: ChunkLength = None) -> DataFrame:
    """``(symbol, interval, chunk, block, _part)``: what indicators need to know of each block of candles."""
    chunked = _chunked_closes(frame, chunk_seconds)
    return _indicator_parts(
        _number_rows(
            chunked.select(*SERIES_KEY, *SERIES_ORDER, "close", CHUNK, F.lit(0).alias(RANK)),
            SERIES_KEY,
            SERIES_ORDER,
            BLOCK_ROWS,
            _delta=_move(),
            _ends=F.lead(F.lit(1), BOLLINGER_ROWS - 1).over(series_window(SERIES_KEY, SERIES_ORDER)).isNull(),
        )
    )


def indicator_states(blocks: DataFrame) -> DataFrame:
    """``(symbol, interval, chunk, _part)`` of ``indicator_blocks``: what later chunks need to know of each chunk."""
    return _chunk_parts(blocks, SERIES_KEY, _merge_parts)


def with_indicators(
    frame: DataFrame, chunk_seconds: ChunkLength = None, *, blocks: DataFrame | None = None, before: DataFrame | None = None
) -> DataFrame:
    """Add the seven indicator columns to candles; columns that are not selected are not computed.

    Where they are stored already, ``blocks`` are the frame's ``indicator_blocks``. ``before`` are the ``indicator_states``
    of chunks that come before all of the frame's: the scan then goes on from them as if their candles were there.
    """
    chunked = _chunked_closes(frame, chunk_seconds)
    along_chunk = series_window(SERIES_KEY, SERIES_ORDER)
    delta = _move()
    parts = indicator_blocks(frame, chunk_seconds) if blocks is None else blocks
    carries = _carry_rows(_block_carries(parts, SERIES_KEY, _merge_parts, before))

    recent = along_chunk.rowsBetween(1 - BOLLINGER_ROWS, Window.currentRow)
    close = F.col("close")
    rows = _number_rows(
        with_carry_rows(chunked, carries),
        SERIES_KEY,
        SERIES_ORDER,
        BLOCK_ROWS,
        _delta=delta,
        # Only the first row of a series has no close before it, just an opening carry row.
        _first=F.lag(RANK).over(along_chunk) == OPENING_RANK,
        bollinger_middle=F.avg("close").over(recent),
        _deviation=F.stddev_pop("close").over(recent),
    ).withColumns(_scan_columns(close, F.col("_delta")))
    running = series_window(SERIES_KEY, SERIES_ORDER, BLOCK).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )

    def running_average(side: str, decay: str) -> Column:
        # At the opening carry row, position 0 of the block, the average enters the sum undecayed.
        entered = F.when(is_row(), F.col(f"_w{side}")).otherwise(F.col(f"_c{side}"))
        return F.sum(entered).over(running) * F.col(decay)

    scanned = rows.withColumns(
        {
            "_e12": running_average("12", "_p12"),
            "_e26": running_average("26", "_p26"),
            "_gain": running_average("gain", "_pw"),
            "_loss": running_average("loss", "_pw"),
            # A series whose first close is missing has no average to start from.
            "_void": F.max((F.col(RANK) == OPENING_RANK) & F.col("_c12").isNull()).over(running),
        }
    ).filter(is_row())
    first, void = F.col("_first"), F.col("_void")
    averages = scanned.withColumns(
        {
            "ema_12": F.when(first, close).when(~void, F.col("_e12")),
            "ema_26": F.when(first, close).when(~void, F.col("_e26")),
            "_avg_gain": F.when(~first, F.col("_gain")),
            "_avg_loss": F.when(~first, F.col("_loss")),
        }
    )
    middle, width = F.col("bollinger_middle"), F.lit(BOLLINGER_WIDTH) * F.col("_deviation")
    return averages.select(
        *frame.columns,
        "ema_12",
        "ema_26",
        (F.col("ema_12") - F.col("ema_26")).alias("macd"),
        rsi(F.col("_avg_gain"), F.col("_avg_loss")).alias("rsi_14"),
        "bollinger_middle",
        (middle + width).alias("bollinger_upper"),
        (middle - width).alias("bollinger_lower"),
    )


def rsi(avg_gain: Column, avg_loss: Column) -> Column:
    """Relative strength index of average gain and loss: 100 without losses, 50 without any move."""
    flat = avg_loss == 0.0
    return (
        F.when(flat & (avg_gain > 0.0), F.lit(100.0))
        .when(flat & (avg_gain == 0.0), F.lit(50.0))
        .otherwise(100.0 - F.lit(100.0) / (1.0 + F.try_divide(avg_gain, avg_loss)))
    )


def calculate_indicators(frame: DataFrame, chunk_seconds: ChunkLength = None) -> DataFrame:
    """Candles with EMA-12, EMA-26, MACD, RSI-14 and Bollinger bands, on the Gold column list."""
    return with_indicators(frame, chunk_seconds).select(*GOLD_COLUMNS)
