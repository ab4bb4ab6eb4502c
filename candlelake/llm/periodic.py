"""Periodic runs: stretches of a text where a group of words comes three times or more in a row.

The detector is an online diagonal DP. Word ``i`` and its earlier occurrence ``i - q`` lie on the diagonal of lag
``q``; while a lag stays active its match length grows, and a diagonal that ends with a sufficient length emits its
run at once. All earlier occurrences of a frequent word would be a square of active lags. Here they are kept sparse
without losing a run:

* A run of period q matches itself at lag q over ``max(24 - q, 2 q)`` words or more, which is 16 at least. So an
  occurrence counts only with its context: the ``w`` words from it on, for ``w`` = 16, 32, 64, ...
* Width ``w`` finds the periods above ``w / 2`` (all up to 16 for the first width). For these the nearest earlier
  occurrence is the only one that can carry a run on: a nearer one of lag d < q would give the stretch the periods d
  and q over d + q words, hence their common divisor (Fine and Wilf), and q were not the smallest.

So each width has one active lag, and the work is words times widths. Widths end where no context repeats.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A run has so many words, and so many times its period, at least.
LEAST_LENGTH, LEAST_PERIODS = 24, 3
#: The fewest consecutive matches that a run of any period has.
FIRST_WIDTH = min(max(LEAST_LENGTH - q, (LEAST_PERIODS - 1) * q) for q in range(1, LEAST_LENGTH + 1))
MIXER = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]
RUN_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
FOUND_TYPE = T.StructType(
    [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN_TYPE)), T.StructField("collapsed", T.StringType())]
)


def numbered(words: list[bytes]) -> np.ndarray:
    """Each word as the number of its first kind."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(word, len(seen)) for word in words], dtype=np.int64)


def may_repeat(ids: np.ndarray) -> bool:
    """False only if no ``FIRST_WIDTH`` words occur twice, which rules out runs; equal hashes may say True for others."""
    mixed, width = (ids.astype(np.uint64) + np.uint64(1)) * MIXER, 1
    while width < FIRST_WIDTH and len(mixed) > width:
        mixed, width = (mixed[:-width] ^ (mixed[:-width] >> np.uint64(29))) * MIXER + mixed[width:], 2 * width
    if width < FIRST_WIDTH:
        return False
    ordered = np.sort(mixed)
    return bool((ordered[1:] == ordered[:-1]).any())


def doubled(ranks: np.ndarray, width: int) -> np.ndarray:
    """Numbers of the contexts of twice the width, equal where the contexts are: from those of one width, exact."""
    pairs = ranks[:-width] * (int(ranks.max()) + 1) + ranks[width:]
    return np.unique(pairs, return_inverse=True)[1]


def diagonals(contexts: list[int]) -> Iterator[tuple[int, int, int]]:
    """(lag, first, last) of the contexts whose nearest earlier occurrence stays at one lag, in the order of their ends."""
    latest: dict[int, int] = {}
    active = begun = 0
    for at, context in enumerate(contexts):
        lag = at - latest.get(context, at)
        latest[context] = at
        if lag != active:
            if active:
                yield active, begun, at - 1
            active, begun = lag, at
    if active:
        yield active, begun, len(contexts) - 1


def find_runs(ids: np.ndarray) -> list[Run]:
    """All runs of a text as (start, length, period), by start, then period.

    A run keeps its smallest period, has ``max(24, 3 * period)`` words or more, and neither neighbour extends it.
    """
    n, found = len(ids), []
    if not may_repeat(ids):
        return found
    ranks, width = ids, 1
    while 2 * width < n:
        ranks, width = doubled(ranks, width), 2 * width
        if width < FIRST_WIDTH:
            continue
        if int(ranks.max()) + 1 == len(ranks):
            break
        least = 1 if width == FIRST_WIDTH else width // 2 + 1
        for lag, first, last in diagonals(ranks.tolist()):
            start, end = first - lag, last + width
            if not least <= lag <= width or end - start < max(LEAST_LENGTH, LEAST_PERIODS * lag):
                continue
            # A diagonal that a nearer occurrence cut short is no run's: those of runs are whole.
            open_left = start > 0 and ids[start - 1] == ids[start - 1 + lag]
            open_right = end < n and ids[end] == ids[end - lag]
            if not open_left and not open_right:
                found.append((start, end - start, lag))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """Words without the repeats: of each run the first period stays, unless another run drops it."""
    if not found:
        return words
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        edges[start + period] += 1
        edges[start + length] -= 1
    return [word for word, covered in zip(words, np.cumsum(edges).tolist(), strict=False) if not covered]


def periodic(text: Column) -> Column:
    """A struct for each whole text: ``n_words``, its ``runs`` by start, then period, and the ``collapsed`` text.

    Words are runs of anything but ASCII white space, compared by their bytes. The collapsed text has each run once,
    words joined by one space. Null is as empty: no words, no runs, an empty collapsed text.
    """

    @F.arrow_udf(FOUND_TYPE)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run_type = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        for batch in batches:
            sizes, runs, texts = [], [], []
            for value in batch:
                words = (value.as_py() or "").encode().split()
                own = find_runs(numbered(words))
                sizes.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in own])
                texts.append(b" ".join(collapsed(words, own)).decode())
            parts = [pa.array(sizes, pa.int64()), pa.array(runs, run_type), pa.array(texts, pa.string())]
            yield pa.StructArray.from_arrays(parts, ["n_words", "runs", "collapsed"])

    return find(text.cast("string"))
