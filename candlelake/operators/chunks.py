"""Time chunks of equal depth.

Chunks of equal length hold equally many rows only where rows come evenly. Here rows are counted by cells of time; a cell
with more rows than a task should see is divided into about ``FANOUT`` cells, again and again, down to a microsecond. Along a
series the counts of the undivided cells are added up, and a new chunk begins with every ``rows`` rows. So a burst is cut
however short it is, and quiet times share a chunk.

Only cells that are too full are counted again. Where there is none, which one aggregate tells, chunks are the cells
themselves and are computed from the time, without a join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlelake.operators.scan import (
    CARRY,
    CHUNK,
    CHUNK_CANDLES,
    PART,
    SPLITS,
    carry_forward,
    chunk_seconds_by_density,
    default_chunk_seconds,
    time_chunk,
)
from candlelake.sources.intermediate import stored

FANOUT = 64
_START = "_start"
_AT = "_at"
_LEAST = 1


@dataclass(frozen=True)
class Chunks:
    """Chunks of the series of a frame: cells of ``seconds``, and below full cells those of ``levels``.

    A level is a stored table of undivided cells: the keys, ``_start`` (microseconds), their ``_chunk``, and into how many
    parts the chunk is split, for a moment with more rows than a chunk should hold cannot be divided by time. ``split``
    holds the chunks of several parts.
    """

    by: tuple[str, ...]
    seconds: Column | int
    levels: tuple[DataFrame, ...] = ()
    split: DataFrame | None = None

    def number(self, frame: DataFrame, time: str) -> DataFrame:
        """Add ``_chunk`` and ``_splits`` to rows whose cells were counted; a row without a time has no chunk."""
        if not self.levels:
            return frame.withColumns({CHUNK: time_chunk(time, self.seconds), SPLITS: F.lit(1)})
        names = frame.columns
        starts = [start.alias(f"_start_{k}") for k, start in enumerate(cell_starts(F.col(time), self.seconds, len(self.levels)))]
        found = frame.select("*", *starts)
        for k, level in enumerate(self.levels):
            keys = [F.col(name).alias(f"_cell_{name}") for name in self.by]
            cells = level.select(*keys, F.col(_START).alias("_cell_start"), F.col(CHUNK).alias(f"_chunk_{k}"), F.col(SPLITS).alias(f"_splits_{k}"))
            same = F.col(f"_start_{k}") == F.col("_cell_start")
            for name in self.by:
                same = same & F.col(name).eqNullSafe(F.col(f"_cell_{name}"))
            found = found.join(cells, same, "left").drop(*[f"_cell_{name}" for name in (*self.by, "start")])

        def first(kind: str) -> Column:
            return F.coalesce(*[F.col(f"_{kind}_{k}") for k in range(len(self.levels))])

        return found.select(*names, first("chunk").alias(CHUNK), F.coalesce(first("splits"), F.lit(1)).alias(SPLITS))


def cell_starts(time: Column, seconds: Column | int, levels: int) -> list[Column]:
    """Where the cells of a moment begin, from the level of whole cells down, in microseconds."""
    at = F.unix_micros(time.cast("timestamp"))
    length = _microseconds(seconds)
    into = F.pmod(at, length)
    starts = [at - into]
    for _ in range(1, levels):
        # What the division leaves over is a further, shorter cell.
        length = F.greatest(F.lit(_LEAST), F.floor(length / FANOUT)).cast("bigint")
        into = F.pmod(into, length)
        starts.append(at - into)
    return starts


def measured_chunks(
    frame: DataFrame, by: Sequence[str], time: str, *, rows: int = CHUNK_CANDLES, seconds: Column | int | None = None
) -> Chunks:
    """Chunks of about ``rows`` rows, twice as many at most, for the series of a frame.

    Cells are ``seconds`` long; without that as long as their interval label says, or where there is none, by the mean
    density of the densest series. Counting runs when this is called: one aggregate over keys and time, and further ones
    over the rows of full cells alone. The driver sees only whether there are such cells.
    """
    by = tuple(by)
    if seconds is None:
        seconds = default_chunk_seconds(by) if "interval" in by else chunk_seconds_by_density(frame, by, time)
    narrow = frame.select(*by, F.col(time).cast("timestamp").alias(_AT)).where(F.col(_AT).isNotNull())

    def counted(at: DataFrame, level: int) -> DataFrame:
        starts = cell_starts(F.col(_AT), seconds, level + 1)
        return at.groupBy(*by, starts[level].alias(_START)).agg(F.count(F.lit(1)).alias("n"))

    cells = counted(narrow, 0)
    # Cells of up to twice the rows may be chunks as they are; only beyond are they worth the counting and the joins.
    if cells.where(F.col("n") > 2 * rows).isEmpty():
        return Chunks(by, seconds)
    levels, deepest = [stored(cells)], _deepest(narrow, seconds)
    while len(levels) <= deepest:
        full = levels[-1].where(F.col("n") > rows)
        if full.isEmpty():
            break
        # What lies in a full cell lies in full cells of all levels above it.
        below = _inside(narrow, full, by, cell_starts(F.col(_AT), seconds, len(levels))[-1])
        levels.append(stored(counted(below, len(levels))))
    return _along_series(levels, by, seconds, rows)


def _deepest(narrow: DataFrame, seconds: Column | int) -> int:
    """The level whose cells are a microsecond long in all series."""
    longest = seconds if isinstance(seconds, int) else narrow.agg(F.max(seconds)).first()[0]
    length, level = int(longest) * 1_000_000, 0
    while length > _LEAST:
        length, level = length // FANOUT, level + 1
    return level


def _inside(rows: DataFrame, full: DataFrame, by: Sequence[str], start: Column) -> DataFrame:
    """Rows in full cells."""
    keys = full.select(*[F.col(name).alias(f"_full_{name}") for name in by], F.col(_START).alias("_full_start"))
    same = start == F.col("_full_start")
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"_full_{name}"))
    return rows.join(keys, same, "left_semi")


def _along_series(levels: list[DataFrame], by: Sequence[str], seconds: Column | int, rows: int) -> Chunks:
    """Number the undivided cells along each series by the rows before them."""
    leaves = None
    for k, level in enumerate(levels):
        last = k == len(levels) - 1
        kept = (level if last else level.where(F.col("n") <= rows)).select(*by, _START, "n", F.lit(k).alias("_level"))
        leaves = kept if leaves is None else leaves.unionByName(kept)
    # Whole cells are what the rows before are folded over; cells within one are few.
    at, length = F.col(_START), _microseconds(seconds)
    whole = leaves.withColumn(CHUNK, ((at - F.pmod(at, length)) / length).cast("bigint"))
    parts = whole.groupBy(*by, CHUNK).agg(F.struct(F.sum("n").alias("n")).alias(PART))
    before = carry_forward(parts, by, lambda a, b: F.struct((a["n"] + b["n"]).alias("n")))
    entering = before.select(*by, CHUNK, F.lit(None).cast("bigint").alias(_START), F.coalesce(f"{CARRY}.n", F.lit(0)).alias("n"))
    order = Window.partitionBy(*by, CHUNK).orderBy(F.col(_START).asc_nulls_first())
    earlier = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = (
        whole.unionByName(entering, allowMissingColumns=True)
        .withColumn("_earlier", earlier)
        .where(F.col(_START).isNotNull())
        .withColumn(CHUNK, F.floor(F.col("_earlier") / rows).cast("bigint"))
    )
    splits = F.ceil(F.sum("n").over(Window.partitionBy(*by, CHUNK)) / (2 * rows)).cast("int")
    numbered = stored(placed.select(*by, _START, "_level", CHUNK, splits.alias(SPLITS)))
    tables = [numbered.where(F.col("_level") == k).drop("_level") for k in range(len(levels))]
    return Chunks(tuple(by), seconds, tuple(tables), numbered.where(F.col(SPLITS) > 1).select(*by, CHUNK, SPLITS).distinct())


def _microseconds(seconds: Column | int) -> Column:
    return (seconds if isinstance(seconds, Column) else F.lit(seconds)).cast("bigint") * 1_000_000
