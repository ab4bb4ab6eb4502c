"""Approximate nearest neighbours by an inverted multi-index.

Two codebooks quantise the two halves of a vector, so a thousand centroids make up to a million cells. For a query, pairs of centroids are taken from a heap by their summed distance until their cells hold enough vectors; all
those are ranked by the exact distance. How many are enough is measured: a sample of vectors is compared with all
others, and the depth is the one at which the wanted share of their true neighbours lies in the cells taken.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlelake.llm.common import stored

#: The codebooks' sample: this many vectors, those with the smallest hashes of their ids, and this many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 32_000_000
MOST_CENTROIDS, VECTORS_PER_CELL, ROUNDS = 1024, 4, 12
BLOCK = 4096
#: Vectors compared with all others to measure the depth, and the share of true neighbours to reach.
PROBES, RECALL = 64, 0.95
QUERIES_PER_TASK, MOST_TASKS = 64, 20_000
SCORED = "query_id long, vec_id long, score double"


def codebook(points: np.ndarray, centroids: int, seed: int) -> np.ndarray:
    """Centroids by k-means; an empty one moves to the point that is worst served."""
    if not points.shape[1]:
        return np.zeros((1, 0))
    distinct = np.unique(points, axis=0)
    if len(distinct) <= centroids:
        return distinct
    centres = distinct[np.random.default_rng(seed).choice(len(distinct), centroids, replace=False)]
    for _ in range(ROUNDS):
        distance = squared(points, centres)
        nearest = distance.argmin(axis=1)
        counts = np.bincount(nearest, minlength=centroids)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        empty = np.flatnonzero(counts == 0)
        centres = sums / np.maximum(counts, 1)[:, None]
        if len(empty):
            centres[empty] = points[np.argsort(distance.min(axis=1), kind="stable")[-len(empty) :]]
    return centres


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1), 0)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def visited(near: np.ndarray, other: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells in order of summed distance to their two centroids until they hold ``wanted`` vectors; empty ones pass."""
    one, two = np.argsort(near, kind="stable"), np.argsort(other, kind="stable")
    a, b = near[one].tolist(), other[two].tolist()
    held = counts.reshape(len(one), len(two))[np.ix_(one, two)]
    heap, cells, found = [(a[0] + b[0], 0, 0)], [], 0
    while heap and found < wanted:
        _, i, j = heap[0]
        if held[i, j]:
            cells.append(int(one[i]) * len(two) + int(two[j]))
            found += int(held[i, j])
        # Each pair enters once: from its left neighbour, and the first of a row from the first of the row before.
        if j + 1 < len(b):
            heapq.heapreplace(heap, (a[i] + b[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if not j and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return cells


def usable(vectors: DataFrame, length: int | None = None) -> DataFrame:
    """(vec_id, embedding array<double>) of the rows that take part: an id, and a vector of the given or else the most
    common length that is neither null nor zero and has no null, NaN or infinite component."""
    typed = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = typed.where(F.col("vec_id").isNotNull() & finite & F.exists("embedding", lambda x: x != 0.0))
    if length is not None:
        return sound.where(F.size("embedding") == length)
    lengths = sound.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return sound.where(F.size("embedding") == (lengths["n"] if lengths else 0))


def fit(vectors: DataFrame, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks of the two halves, fitted on the bounded sample; their size follows the number of vectors."""
    n, dimension = vectors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    rows = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * max(1, dimension))))
    taken = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows).select("embedding").toArrow()
    points = matrix(taken["embedding"].combine_chunks()) if taken.num_rows else np.zeros((1, max(1, dimension)))
    half, k = -(-points.shape[1] // 2), int(np.clip(round((n / VECTORS_PER_CELL) ** 0.5), 1, MOST_CENTROIDS))
    return codebook(points[:, :half], k, seed), codebook(points[:, half:], k, seed)


def _assigned(one: np.ndarray, two: np.ndarray) -> Callable:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points, half = matrix(batch.column(1)), one.shape[1]
                cell = squared(points[:, :half], one).argmin(1) * len(two) + squared(points[:, half:], two).argmin(1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], names=["vec_id", "embedding", "cell"])

    return assign


def _best(probes: np.ndarray, probe_ids: np.ndarray, k: int) -> Callable:
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k nearest of each batch for each probe, with their cells."""
        for batch in batches:
            if batch.num_rows:
                ids, cells = batch.column(0).to_numpy(), batch.column(2).to_numpy()
                distance = squared(probes, matrix(batch.column(1)))
                distance[probe_ids[:, None] == ids[None, :]] = np.inf
                near = np.argsort(distance, axis=1, kind="stable")[:, :k]
                probe = np.repeat(np.arange(len(probes)), near.shape[1])
                columns = [probe, np.take_along_axis(distance, near, 1).ravel(), ids[near.ravel()], cells[near.ravel()]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["probe", "distance", "vec_id", "cell"])

    return best


def depth(placed: DataFrame, one: np.ndarray, two: np.ndarray, counts: np.ndarray, k: int, recall: float) -> int:
    """How many vectors a query's cells must hold for ``recall``, by the true neighbours of ``PROBES`` vectors.

    The probes are those with the smallest hashes of their ids; each task keeps ``k`` candidates for each, so this is
    one pass over the vectors whose result has ``PROBES * k`` rows.
    """
    taken = placed.orderBy(F.xxhash64("vec_id", F.lit("probe")), "vec_id").limit(PROBES).select("vec_id", "embedding").toArrow()
    if not taken.num_rows:
        return k
    probes, ids = matrix(taken["embedding"].combine_chunks()), taken["vec_id"].to_numpy()
    near = placed.select("vec_id", "embedding", "cell").mapInArrow(_best(probes, ids, k), "probe long, distance double, vec_id long, cell int")
    place = F.row_number().over(Window.partitionBy("probe").orderBy("distance", "vec_id"))
    true = near.withColumn("place", place).where((F.col("place") <= k) & (F.col("distance") < float("inf"))).select("probe", "cell").collect()
    half, needed = one.shape[1], []
    near, other = squared(probes[:, :half], one), squared(probes[:, half:], two)
    for probe in range(len(probes)):
        order = np.argsort((near[probe][:, None] + other[probe][None, :]).ravel(), kind="stable")
        held = np.empty(len(order), np.int64)
        held[order] = np.cumsum(counts[order])
        needed += [held[r["cell"]] for r in true if r["probe"] == probe]
    return int(np.quantile(needed, recall, method="higher")) if needed else k


def groups_of_cells(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of each cell: cells in a row share a group of ``BLOCK`` vectors; a cell that
    has more is cut into several groups of its own."""
    first, parts, group, held = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), 0, 0
    for cell in np.flatnonzero(counts):
        n = int(counts[cell])
        if held and held + n > BLOCK:
            group, held = group + 1, 0
        first[cell], parts[cell] = group, -(-n // BLOCK)
        group, held = (group + int(parts[cell]), 0) if n > BLOCK else (group, held + n)
    return first, parts


def _grouped(first: np.ndarray, parts: np.ndarray) -> Callable:
    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cells = batch.column(0).to_numpy().astype(np.uint64), batch.column(2).to_numpy()
            turned = (ids * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
            found = first[cells] + (turned % parts[cells].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int64())], names=["vec_id", "embedding", "cell", "group"])

    return group


def _visits(one: np.ndarray, two: np.ndarray, counts: np.ndarray, first: np.ndarray, parts: np.ndarray, wanted: int) -> Callable:
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query once for each group with cells that it visits, with these cells."""
        for batch in batches:
            if not batch.num_rows:
                continue
            points, half, rows, groups, lists = matrix(batch.column(1)), one.shape[1], [], [], []
            near, other = squared(points[:, :half], one), squared(points[:, half:], two)
            for row, (a, b) in enumerate(zip(near, other, strict=True)):
                by_group: dict[int, list[int]] = defaultdict(list)
                for cell in visited(a, b, counts, wanted):
                    for part in range(int(parts[cell])):
                        by_group[int(first[cell]) + part].append(cell)
                rows += [row] * len(by_group)
                groups += by_group
                lists += by_group.values()
            at = pa.array(rows, pa.int64())
            columns = [batch.column(0).take(at), batch.column(1).take(at), pa.array(groups, pa.int64()), pa.array(lists, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "query", "group", "cells"])

    return visit


def _ranked(k: int) -> Callable:
    def rank(key: tuple, vectors: pa.Table, queries: pa.Table) -> pa.Table:
        """The k nearest of one group for each query, among the cells that it visits there."""
        out: list[tuple[np.ndarray, ...]] = []
        if vectors.num_rows and queries.num_rows:
            order = np.argsort(vectors["cell"].to_numpy(), kind="stable")
            cells, ids = vectors["cell"].to_numpy()[order], vectors["vec_id"].to_numpy()[order]
            points = matrix(vectors["embedding"].combine_chunks())[order]
            asked = queries["query_id"].to_numpy(), matrix(queries["query"].combine_chunks()), queries["cells"].to_pylist()
            for query_id, query, own in zip(*asked, strict=True):
                chosen = np.flatnonzero(np.isin(cells, own) & (ids != query_id))
                score = np.sqrt(((points[chosen] - query) ** 2).sum(axis=1))
                near = np.flatnonzero(score <= np.partition(score, k - 1)[k - 1]) if len(score) > k else np.arange(len(score))
                near = near[np.lexsort((ids[chosen[near]], score[near]))][:k]
                out.append((np.full(len(near), query_id), ids[chosen[near]], score[near]))
        parts = zip(*out, strict=True) if out else [[]] * 3
        columns = [np.concatenate([np.zeros(0, t), *c]) for t, c in zip((np.int64, np.int64, np.float64), parts, strict=True)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    return rank


def nearest(vectors: DataFrame, queries: DataFrame, *, k: int = 10, recall: float = RECALL, seed: int = 42) -> DataFrame:
    """The ``k`` nearest found of ``vectors`` (vec_id, embedding) for each of ``queries``: (query_id, rank, vec_id, score).

    Rows with the query's own id are no candidates; repeated query ids count once, repeated candidates stay repeated;
    ties go to the smaller id; a query gets all candidates where they are fewer. Rows that ``usable`` leaves out take no
    part on either side. Every vector is indexed. A group of vectors has ``BLOCK`` at most, by a hash where one cell has
    more, and is repeated for every ``BLOCK`` queries that visit it. The table of cells has
    ``MOST_CENTROIDS`` squared rows at most, about a million.
    """
    sound = usable(vectors)
    one, two = fit(sound, seed)
    placed = stored(sound.mapInArrow(_assigned(one, two), "vec_id long, embedding array<double>, cell int"))
    counts = np.zeros(len(one) * len(two), np.int64)
    filled = placed.groupBy("cell").count().toArrow()
    counts[filled["cell"].to_numpy()] = filled["count"].to_numpy()
    wanted = max(k + 1, depth(placed, one, two, counts, k, recall))
    first, parts = groups_of_cells(counts)
    asked = usable(queries, one.shape[1] + two.shape[1]).dropDuplicates(["vec_id"])
    # Walking the heap is the work of a query, not reading it: few of them to a task, whatever their size in bytes.
    tasks = min(MOST_TASKS, -(-max(1, asked.count()) // QUERIES_PER_TASK))
    asked = asked.repartition(tasks, "vec_id")
    visiting = _visits(one, two, counts, first, parts, wanted)
    visits = stored(asked.mapInArrow(visiting, "query_id long, query array<double>, group long, cells array<int>"))
    grouped = placed.mapInArrow(_grouped(first, parts), "vec_id long, embedding array<double>, cell int, group long")
    turns = visits.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("turns"))
    turn = F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn")
    split = grouped.join(turns, "group").select("group", turn, "vec_id", "embedding", "cell")
    own_turn = F.pmod(F.xxhash64("query_id"), F.col("turns")).cast("int").alias("turn")
    spread = visits.join(turns, "group").select("group", own_turn, "query_id", "query", "cells")
    keys = ["group", "turn"]
    scores = split.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(_ranked(k), SCORED)
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return scores.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
