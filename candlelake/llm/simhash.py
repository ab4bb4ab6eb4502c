"""Near-duplicate documents by SimHash, with candidates from pigeonring filtering.

A 64-bit fingerprint is seen as a ring of four 16-bit segments. If two fingerprints differ in at most 3 bits, there is
a segment from which the differences, added up along the ring, never exceed the proportional budget: 0 in the
segment, 1 in two, 2 in three, 3 in all. So every linked pair agrees in one segment and differs by one bit at
most in the next. Fingerprints are filed under those 32 bits and looked up there with one bit turned; a pair must
keep the budgets along its chain before the full distance is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.llm.common import small, stored
from candlelake.llm.components import connected_components

SHINGLE, SEED, SEGMENTS, SEGMENT_BITS, MOST_BITS = 3, 42, 4, 16, 3
BLOCK = 4096
FEW = 8


def _fingerprint(text: bytes) -> int:
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(SHINGLE)), strict=False))
    raw = np.frombuffer(b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED))), dtype=np.uint8).reshape(-1, 8)
    n = len(raw)
    if n % 255:
        raw = np.concatenate([raw, np.zeros((255 - n % 255, 8), np.uint8)])
    # 255 ones fit a byte, so the sums stay in bytes for most of the way.
    by_255 = np.add.reduce(np.unpackbits(raw, axis=1).reshape(-1, 255, 64), axis=1, dtype=np.uint8)
    bits = 2 * by_255.sum(axis=0, dtype=np.int64) > n
    return int(np.packbits(bits).view(">i8")[0])


@F.arrow_udf(T.LongType())
def _fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        binary = batch.cast(pa.binary())
        yield pa.array((_fingerprint(t.as_py() or b"") for t in binary), pa.int64())


def fingerprint(text: Column) -> Column:
    """The SimHash of a whole text, as a signed 64-bit number; a text without words, or null, has 0."""
    return _fingerprints(text.cast("string"))


def _filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint under its four keys, and under those with one zero bit of the second segment set."""
    mask = np.uint64((1 << SEGMENT_BITS) - 1)
    for batch in batches:
        values = batch.column(0).to_numpy()
        prints, keys, own = values.view(np.uint64), [], []
        for start in range(SEGMENTS):
            turned = _turned(prints, start)
            first, second = turned & mask, turned >> np.uint64(SEGMENT_BITS) & mask
            base = np.uint64(start << 2 * SEGMENT_BITS) | first << np.uint64(SEGMENT_BITS)
            keys.append(base | second)
            own.append(values)
            for bit in range(SEGMENT_BITS):
                flag = np.uint64(1 << bit)
                zero = (second & flag) == 0
                keys.append(base[zero] | second[zero] | flag)
                own.append(values[zero])
        columns = [np.concatenate(keys).view(np.int64), np.concatenate(own)]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "print"])


def _turned(prints: np.ndarray, start: np.ndarray | int) -> np.ndarray:
    """The ring from a segment on, that segment in the lowest bits."""
    by = np.asarray(start, dtype=np.uint64) * np.uint64(SEGMENT_BITS)
    return prints >> by | prints << (np.uint64(64) - by) % np.uint64(64)


def _viable(different: np.ndarray) -> np.ndarray:
    """Whether the bits that differ, turned to the chain's start, keep every budget, the last being the full distance."""
    kept = np.ones(different.shape, bool)
    for length in range(1, SEGMENTS + 1):
        part = np.uint64((1 << length * SEGMENT_BITS) - 1)
        kept &= np.bitwise_count(different & part) <= length * MOST_BITS // SEGMENTS
    return kept


def _tree(turned: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what viable pairs connect, one fewer than members at most: breadth first, by row."""
    left, links = np.arange(len(turned)), []
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = _viable(turned[left] ^ turned[at])
            found = left[near].tolist()
            links += [(at, other) for other in found]
            queue += found
            left = left[~near]
    return links


def _linked(keys: np.ndarray, pairs: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal (key, pair)."""
    cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (pairs[1:] != pairs[:-1])) + 1
    starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
    turned, sizes, left, right = _turned(prints, keys >> np.int64(2 * SEGMENT_BITS)), ends - starts, [], []
    for size in range(2, FEW + 1):
        rows = starts[sizes == size]
        for i in range(size):
            for j in range(i + 1, size):
                near = _viable(turned[rows + i] ^ turned[rows + j])
                left.append(rows[near] + i)
                right.append(rows[near] + j)
    for run in np.flatnonzero(sizes > FEW):
        if links := _tree(turned[starts[run] : ends[run]]):
            found = np.array(links) + starts[run]
            left.append(found[:, 0])
            right.append(found[:, 1])
    chosen = [np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right)]
    return prints[chosen[0]].view(np.int64), prints[chosen[1]].view(np.int64)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by (key, pair); the last run of a batch waits for the next batch."""
    kept = [np.zeros(0, np.int64)] * 3
    names = ["a", "b"]
    for batch in batches:
        keys, pairs, prints = (np.concatenate([k, batch.column(i).to_numpy()]) for i, k in enumerate(kept))
        if not len(keys):
            continue
        others = np.flatnonzero((keys != keys[-1]) | (pairs != pairs[-1]))
        done = int(others[-1]) + 1 if len(others) else 0
        if done:
            a, b = _linked(keys[:done], pairs[:done], prints[:done].view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=names)
        kept = [x[done:] for x in (keys, pairs, prints)]
    if len(kept[0]):
        a, b = _linked(kept[0], kept[1], kept[2].view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=names)


def _refiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each fingerprint of a hot key under its two other segments, and under those with one zero bit set.

    A pair that the chain keeps differs there by 3 bits at most, so by one at most in one of the two.
    """
    mask = np.uint64((1 << SEGMENT_BITS) - 1)
    for batch in batches:
        keys, values = (batch.column(i).to_numpy() for i in range(2))
        turned, parts, rows = _turned(values.view(np.uint64), keys >> np.int64(2 * SEGMENT_BITS)), [], []
        for which in (2, 3):
            segment = turned >> np.uint64(which * SEGMENT_BITS) & mask
            base = np.uint64(which << SEGMENT_BITS)
            parts.append(base | segment)
            rows.append(np.arange(len(values)))
            for bit in range(SEGMENT_BITS):
                flag = np.uint64(1 << bit)
                zero = np.flatnonzero((segment & flag) == 0)
                parts.append(base | segment[zero] | flag)
                rows.append(zero)
        row = np.concatenate(rows)
        columns = [keys[row], np.concatenate(parts).view(np.int64), values[row]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "part", "print"])


def _with_counts(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, bool]:
    """Rows with ``n``, how many their keys have where those are more than ``BLOCK``, else null; whether there are such.

    Counts are added up before the shuffle and only those of hot keys come back, by a join: no key meets in one task.
    """
    hot = stored(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK))
    if hot.isEmpty():
        return rows.withColumn("n", F.lit(None).cast("long")), False
    named = small(hot.select(*[F.col(k).alias(f"__{k}") for k in keys], "n"))
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"__{k}"))
    return rows.join(named, same, "left").drop(*[f"__{k}" for k in keys]), True


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) that connect all of the distinct fingerprints (print long) at most 3 bits apart.

    Within a key a spanning forest is kept, not every pair. The fingerprints of a key with more than ``BLOCK`` are filed
    again under their other two segments. Where even those keys have more, which takes as many fingerprints within some bits
    of each other, they are cut into blocks by a hash, and each pair of blocks is a group of its own. So no group is larger
    than two blocks and no link is lost.
    """
    filed = prints.mapInArrow(_filed, "key long, print long")
    counted, hot = _with_counts(filed, ["key"])
    grouped = counted.where(F.col("n").isNull()).select("key", F.lit(0).cast("long").alias("pair"), "print")
    if hot:
        again = counted.where(F.col("n").isNotNull()).select("key", "print").mapInArrow(_refiled, "key long, part long, print long")
        parts, _ = _with_counts(again, ["key", "part"])
        blocks = F.coalesce(F.ceil(F.col("n") / BLOCK), F.lit(1)).cast("long")
        own = F.pmod(F.xxhash64("print"), blocks)
        pairs = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda c: F.shiftleft("part", 32) + F.least(own, c) * blocks + F.greatest(own, c))
        grouped = grouped.unionByName(parts.select("key", F.explode(pairs).alias("pair"), "print"))
    ready = grouped.repartition("key", "pair").sortWithinPartitions("key", "pair")
    return ready.mapInArrow(_links, "a long, b long")


def print_components(prints: DataFrame) -> DataFrame:
    """(print, component, component_id) from (print, doc_id): the smallest doc_id reachable over links.

    ``component`` is the smallest fingerprint there, which is never null.
    """
    distinct = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first_id")))
    nodes = connected_components(near_links(distinct.select("print")))
    joined = stored(nodes.join(distinct, nodes["node"] == distinct["print"]).select("print", "component", "first_id"))
    least = joined.groupBy("component").agg(F.min("first_id").alias("least_id"))
    reached = joined.join(least, "component").select("print", "component", "least_id")
    component_id = F.when(F.col("component").isNull(), F.col("first_id")).otherwise(F.col("least_id"))
    component = F.coalesce("component", "print").alias("component")
    return distinct.join(reached, "print", "left").select("print", component, component_id.alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, print, component_id) for every row of documents (doc_id, text, ...).

    Shingles of three words, lower-cased in A-Z, repeats included; fewer words are one shingle. Texts without words
    share fingerprint 0 and so are linked. Null ids take part and get a component's smallest id; it is null only if
    every row of the component has none. Repeated rows stay repeated; no rows give no rows.
    """
    prints = stored(docs.select(F.col("doc_id").cast("long"), fingerprint(F.col("text")).alias("print")))
    found = print_components(prints)
    return prints.join(found, "print").select("doc_id", "print", "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id (then by a hash of its text), columns as given.

    Rows equal in id and text are told apart by a hash of their other columns, so reruns keep the same one; of rows
    equal in all columns one stays. Two hashes of id and text and that third one stand for a row.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    one, two = F.xxhash64(doc_id, text), F.xxhash64(text, F.lit("second"), doc_id)
    others = [F.col(f"`{name}`") for name in docs.columns if name not in ("doc_id", "text")]
    three = F.xxhash64(F.to_json(F.struct(*others), {"ignoreNullFields": "false"})) if others else F.lit(0).cast("long")
    marks = {"__one": one, "__two": two, "__three": three}
    keyed = stored(docs.select(doc_id.alias("doc_id"), fingerprint(text).alias("print"), *[c.alias(name) for name, c in marks.items()]))
    found = keyed.join(print_components(keyed.select("doc_id", "print")), "print")
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", *marks)
    stay = found.groupBy("component").agg(F.min(place).alias("p")).select(*[f"p.{name}" for name in marks])
    return docs.withColumns(marks).join(stay, list(marks), "left_semi").dropDuplicates(list(marks)).drop(*marks)
