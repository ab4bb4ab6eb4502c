"""Shuffle documents into shards by a Feistel permutation of their global row numbers.

Shard and slot follow from the row number by arithmetic alone, so any row's place can be computed without the
data, and the same rows in the same order always get the same places.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import number_rows

ROUNDS = 6
MULTIPLIER = 2_654_435_761
MASK = (1 << 31) - 1
#: The domain exceeds the rows by less than its side. Up to 4096 rows a walk cannot meet 64 numbers outside;
#: beyond, each step stays outside with a chance of at most 1 in 64.
WALK_STEPS = 64


def round_keys(seed: int) -> list[int]:
    return [((seed + 1) * 1_000_003 + k * 7_368_787) * MULTIPLIER % MASK for k in range(ROUNDS)]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to a value that is computed once, however often it is named there."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _mixed(half: Column, key: int, size: int) -> Column:
    """A round's function: two multiplications of 31-bit numbers, which fit in a signed long."""
    once = (half.bitwiseXOR(F.lit(key)) * F.lit(MULTIPLIER)).bitwiseAND(F.lit((1 << 62) - 1))

    def twice(x: Column) -> Column:
        folded = x.bitwiseXOR(F.shiftright(x, 29)).bitwiseAND(F.lit(MASK))
        return F.shiftright(folded * F.lit(MULTIPLIER), 17) % F.lit(size)

    return bound(once, twice)


def quotient(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by))


def permuted(number: Column, rows: int, seed: int) -> Column:
    """One pass over a domain a * b of at least ``rows`` numbers: halves are changed in turn, each by the other."""
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    b = max(1, -(-rows // a))

    def turned(turn: int, key: int) -> Callable[[Column], Column]:
        def use(state: Column) -> Column:
            high, low = state["high"], state["low"]
            if turn % 2:
                low = (low + _mixed(high, key, b)) % F.lit(b)
            else:
                high = (high + _mixed(low, key, a)) % F.lit(a)
            return F.struct(high.alias("high"), low.alias("low"))

        return use

    state = F.struct(quotient(number, b).alias("high"), (number % F.lit(b)).alias("low"))
    for turn, key in enumerate(round_keys(seed)):
        state = bound(state, turned(turn, key))
    return bound(state, lambda s: s["high"] * F.lit(b) + s["low"])


def walked(number: Column, rows: int, seed: int) -> Column:
    """Cycle walking: permute until the number is one of the rows'."""
    steps = F.sequence(F.lit(1), F.lit(WALK_STEPS))

    def on(first: Column) -> Column:
        return F.aggregate(steps, first, lambda x, _: F.when(x < rows, x).otherwise(permuted(x, rows, seed)))

    unfinished = F.raise_error(F.lit("cycle walk left unfinished")).cast("long")
    return bound(bound(permuted(number, rows, seed), on), lambda walk: F.when(walk < rows, walk).otherwise(unfinished))


def shard_rows(rows: DataFrame, order: Sequence[Column], *, shards: int = 8, seed: int = 42) -> DataFrame:
    """All rows with ``row_number``, ``shard`` and ``slot``; shard sizes differ by one at most, slots are gapless.

    Rows are numbered in the given order; rows that tie in it are interchangeable, so the order should name every
    column that matters. Input columns of these three names are replaced. No rows give no rows.
    """
    own = [c for c in rows.columns if c not in ("row_number", "shard", "slot")]
    numbered = number_rows(rows.select(*own), order, "row_number")
    total = numbered.count()
    place = numbered.withColumn("__place", walked(F.col("row_number"), total, seed))
    shard = (F.col("__place") % F.lit(shards)).cast("int")
    return place.withColumns({"shard": shard, "slot": quotient(F.col("__place"), shards)}).drop("__place")


def write_shards(sharded: DataFrame, path: str, files_per_shard: int = 1) -> None:
    """One folder per shard, rows in order of slots; large shards are cut into several files by ranges of slots."""
    n = sharded.select("shard").distinct().count() * files_per_shard
    laid = sharded.repartitionByRange(max(1, n), "shard", "slot").sortWithinPartitions("shard", "slot")
    laid.write.partitionBy("shard").parquet(path)
