"""Remove passages that repeat across documents, with a count-min sketch before exact grouping.

A window is 13 consecutive words. Documents lie in chunks by a hash, and the sketch's cells in segments:

1. each chunk lists the cells that its windows meet in both rows of the sketch; a segment's reducer adds the lists
   of all chunks and answers each with one bit per cell: whether its count is 2 or more;
2. windows whose cells all have such counts are estimated repeated, so no repeated one is lost; each chunk sends
   only their 96-bit keys with the smallest document id it knows, and a key range's reducer answers with one bit
   per key: whether a smaller id exists elsewhere;
3. each chunk removes the words that the windows so found cover.

The sketch grows with the text and is never in one place; answers are bits in the order of what was sent.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import worker_store

WINDOW = 13
#: A chunk is what one call has in memory: so many bytes, or as many as give a list so many windows, up to a most.
CHUNK_BYTES, LIST_WINDOWS, WINDOW_BYTES, MOST_CHUNK_BYTES = 4_000_000, 64, 6, 32_000_000
#: Beyond so many, chunks share shuffle partitions; a task takes its chunks one after the other.
MOST_PARTITIONS = 65_536
CELLS_PER_BYTE = 0.7  # about four for each window: a word takes six bytes
#: A row of the sketch has about this many segments, of this many bits of cells; only at the most do segments multiply.
SEGMENTS, LEAST_CELL_BITS, MOST_CELL_BITS = 256, 12, 28
#: Key ranges: this many, or one for so many bytes of text if that makes more.
RANGES, BYTES_PER_RANGE = 64, 16_000_000
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
NO_ID = np.iinfo(np.int64).max

ANSWER = "chunk int, kind int, part int, bits binary"


def _deltas(values: np.ndarray) -> bytes:
    """Sorted numbers as compressed differences, with the width of a difference in the first byte."""
    import zstandard

    steps = np.diff(values, prepend=values.dtype.type(0))
    width = next(w for w in (1, 2, 4, 8) if w == 8 or int(steps.max(initial=0)) < 1 << 8 * w)
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(steps.astype(f"<u{width}").tobytes())


def _undone(blob: bytes) -> np.ndarray:
    import zstandard

    steps = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), dtype=f"<u{blob[0]}")
    return np.cumsum(steps.astype(np.uint64), dtype=np.uint64)


def _bits(blobs: list[bytes], counts: list[int]) -> np.ndarray:
    """Answers in order of their parts, each as long as what it answers."""
    parts = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(blobs, counts, strict=True)]
    return np.concatenate([np.zeros(0, np.uint8), *parts]).astype(bool)


@dataclass(frozen=True)
class Size:
    """Parts of the work for a number of bytes of text."""

    chunks: int
    segments: int
    bits: int
    ranges: int

    @property
    def partitions(self) -> int:
        return min(self.chunks, MOST_PARTITIONS)

    @classmethod
    def of(cls, text_bytes: int) -> Size:
        cells = max(1, int(text_bytes * CELLS_PER_BYTE))
        bits = min(MOST_CELL_BITS, max(LEAST_CELL_BITS, (cells // SEGMENTS).bit_length()))
        ranges = max(RANGES, -(-text_bytes // BYTES_PER_RANGE))
        segments = -(-cells >> bits) or 1
        chunk_bytes = min(MOST_CHUNK_BYTES, max(CHUNK_BYTES, segments * LIST_WINDOWS * WINDOW_BYTES))
        return cls(max(1, -(-text_bytes // chunk_bytes)), segments, bits, ranges)


class Windows:
    """All windows of a chunk's documents, as two 64-bit hashes of their words' 64-bit hashes."""

    def __init__(self, table: pa.Table) -> None:
        import xxhash

        worker_store("windows")  # lets go of what other stages kept
        self.words, digests = [], []
        for text in table["text"].cast(pa.large_binary()).to_pylist():
            words = (text or b"").split()
            self.words.append(words)
            digests.append(b"".join(map(xxhash.xxh3_128_digest, words)))
        lanes = np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)
        lengths = np.array([len(w) for w in self.words], dtype=np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(lengths)])
        document = np.repeat(np.arange(len(lengths)), lengths)
        n = max(0, len(document) - WINDOW + 1)
        self.starts = np.flatnonzero(document[:n] == document[WINDOW - 1 :]) if n else np.zeros(0, np.int64)
        self.document = document[self.starts]
        self.hashes = [self._hash(lanes[:, k], n, np.uint64(FACTORS[k])) for k in (0, 1)]
        ids = table["doc_id"].combine_chunks().cast(pa.int64())
        self.ids = ids.fill_null(NO_ID).to_numpy(zero_copy_only=False)[self.document] if len(self.starts) else np.zeros(0, np.int64)

    def _hash(self, lane: np.ndarray, n: int, factor: np.uint64) -> np.ndarray:
        out = np.zeros(n, np.uint64)
        for k in range(WINDOW):
            out *= factor
            out += lane[k : k + n]
        out = out[self.starts]
        out ^= out >> np.uint64(32)
        out *= factor
        return out ^ out >> np.uint64(29)


class Sketch:
    """The cells of a chunk's windows in one row of the sketch, by segment."""

    def __init__(self, hashes: np.ndarray, size: Size) -> None:
        self.bits = np.uint64(size.bits)
        segment = (hashes >> np.uint64(32)) * np.uint64(size.segments) >> np.uint64(32)
        self.codes = segment << self.bits | hashes & np.uint64((1 << size.bits) - 1)
        self.cells, self.counts = np.unique(self.codes, return_counts=True)
        limits = np.arange(size.segments + 1, dtype=np.uint64) << self.bits
        self.limits = np.searchsorted(self.cells, limits)

    def lists(self) -> list[tuple[int, bytes]]:
        first = np.uint64((1 << int(self.bits)) - 1)
        edges = zip(self.limits[:-1], self.limits[1:], strict=True)
        return [(k, _deltas(self.cells[a:b] & first)) for k, (a, b) in enumerate(edges) if b > a]

    def filled(self) -> np.ndarray:
        return np.diff(self.limits)[np.diff(self.limits) > 0]


class Repeated:
    """The windows estimated repeated, by sorted key; a key is 96 bits of a window's hashes."""

    def __init__(self, table: pa.Table, answers: pa.Table, size: Size) -> None:
        self.windows = windows = Windows(table)
        asked = answers.filter(pc.equal(answers["kind"], 0)).sort_by("part")
        blobs, at, chosen = asked["bits"].to_pylist(), 0, np.arange(len(windows.starts))
        for row in (0, 1):
            sketch = Sketch(windows.hashes[row], size)
            filled = sketch.filled()
            often = _bits(blobs[at : at + len(filled)], filled.tolist()) | (sketch.counts > 1)
            at += len(filled)
            chosen = chosen[often[np.searchsorted(sketch.cells, sketch.codes[chosen])]]
        one, two, ids = windows.hashes[0][chosen], windows.hashes[1][chosen] >> np.uint64(32), windows.ids[chosen]
        order = np.lexsort((ids, two, one))
        self.chosen, one, two, self.own_ids = chosen[order], one[order], two[order], ids[order]
        fresh = np.ones(len(one), bool)
        fresh[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        self.key_of = np.cumsum(fresh) - 1
        self.one, self.two, self.least = one[fresh], two[fresh], self.own_ids[fresh]
        # Ranges of the first hash's upper half.
        found = (self.one >> np.uint64(32)) * np.uint64(size.ranges) >> np.uint64(32)
        self.limits = np.searchsorted(found, np.arange(size.ranges + 1, dtype=np.uint64))

    def removed(self, answers: pa.Table) -> list[np.ndarray]:
        """Per document, which words go: those of windows that a smaller id has, here or elsewhere."""
        asked = answers.filter(pc.equal(answers["kind"], 1)).sort_by("part")
        sizes = np.diff(self.limits)
        elsewhere = _bits(asked["bits"].to_pylist(), sizes[sizes > 0].tolist())
        late = elsewhere[self.key_of] | (self.own_ids > self.least[self.key_of])
        starts, offsets = self.windows.starts[self.chosen[late]], self.windows.offsets
        change = np.zeros(offsets[-1] + 1, np.int32)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + WINDOW, -1)
        covered = np.cumsum(change)[:-1] > 0
        return [covered[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _cells_of(size: Size) -> Callable:
    def send(key: tuple, table: pa.Table) -> pa.Table:
        windows = Windows(table)
        rows = [(row * size.segments + k, blob) for row in (0, 1) for k, blob in Sketch(windows.hashes[row], size).lists()]
        parts, blobs = [r[0] for r in rows], [r[1] for r in rows]
        chunk = pa.array([key[0].as_py()] * len(rows), pa.int32())
        return pa.table({"chunk": chunk, "part": pa.array(parts, pa.int32()), "cells": pa.array(blobs, pa.binary())})

    return send


def _often_in(size: Size) -> Callable:
    def often(key: tuple, table: pa.Table) -> pa.Table:
        """Add one segment's lists, counting up to 2, and answer each; one list is unpacked at a time."""
        counts = np.zeros(1 << size.bits, np.uint8)
        for blob in table["cells"]:
            cells = _undone(blob.as_py())
            counts[cells] = np.minimum(counts[cells] + 1, 2)
        bits = [np.packbits(counts[_undone(blob.as_py())] > 1).tobytes() for blob in table["cells"]]
        n = table.num_rows
        return pa.table(
            {"chunk": table["chunk"], "kind": pa.array([0] * n, pa.int32()), "part": table["part"], "bits": pa.array(bits, pa.binary())}
        )

    return often


def _keys_of(size: Size) -> Callable:
    def send(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        import zstandard

        found, rows = Repeated(table, answers, size), []
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for part, (a, b) in enumerate(zip(found.limits[:-1], found.limits[1:], strict=True)):
            if b > a:
                rest = found.two[a:b].astype("<u4").tobytes()
                rows.append((part, _deltas(found.one[a:b]), rest, squeeze(found.least[a:b].tobytes())))
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        chunk = key[0].as_py() if table.num_rows else None
        arrays = [pa.array([chunk] * len(rows), pa.int32()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))]
        return pa.Table.from_arrays(arrays, names=["chunk", "part", "one", "two", "ids"])

    return send


def _earlier(key: tuple, table: pa.Table) -> pa.Table:
    """For each chunk's keys of one range: whether another chunk knows a smaller id."""
    import zstandard

    plain = zstandard.ZstdDecompressor().decompress
    ones = [_undone(b) for b in table["one"].to_pylist()]
    sizes = [len(x) for x in ones]
    one = np.concatenate(ones)
    two = np.concatenate([np.frombuffer(b, "<u4") for b in table["two"].to_pylist()])
    ids = np.concatenate([np.frombuffer(plain(b), "<i8") for b in table["ids"].to_pylist()])
    order = np.lexsort((ids, two, one))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (one[order[1:]] != one[order[:-1]]) | (two[order[1:]] != two[order[:-1]])
    least = ids[order[fresh]][np.cumsum(fresh) - 1]
    late = np.zeros(len(order), bool)
    late[order] = ids[order] > least
    cuts = np.cumsum([0, *sizes])
    bits = [np.packbits(late[a:b]).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    n = table.num_rows
    return pa.table({"chunk": table["chunk"], "kind": pa.array([1] * n, pa.int32()), "part": table["part"], "bits": pa.array(bits, pa.binary())})


def _cut(size: Size, names: list[str]) -> Callable:
    def cut(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        found = Repeated(table, answers, size)
        texts, counts, gone = [], [], []
        given = table["text"].to_pylist()
        for text, words, removed in zip(given, found.windows.words, found.removed(answers), strict=True):
            n = int(removed.sum())
            kept = b" ".join([w for w, r in zip(words, removed.tolist(), strict=True) if not r]).decode() if n else text
            texts.append(kept)
            counts.append(len(words))
            gone.append(n)
        out = table.select(names).set_column(names.index("text"), "text", pa.array(texts, pa.string()))
        return out.append_column("n_words", pa.array(counts, pa.int64())).append_column("n_removed", pa.array(gone, pa.int64()))

    return cut


def remove_repeated(docs: DataFrame) -> DataFrame:
    """Documents without the words of windows that also start in a document with a smaller id; plus two counts.

    A document that loses nothing keeps its text as it is; in others the kept words are joined by single spaces.
    Windows are judged on the input. ``n_words`` and ``n_removed`` (long) replace input columns of these names; the
    rest passes. A null text has no words and stays null; a null id is larger than any other and equal to itself;
    rows with one id do not make each other repeated. No rows give no rows.
    """
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "__chunk")]
    size = Size.of(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(size.chunks)).cast("int").alias("__chunk")
    typed = docs.select(*names).withColumns({"doc_id": F.col("doc_id").cast("long"), "text": F.col("text").cast("string")})
    # One exchange of the texts serves all three passes.
    laid = typed.select("*", chunk).repartition(size.partitions, "__chunk")
    by_chunk = laid.groupBy("__chunk")
    cells = by_chunk.applyInArrow(_cells_of(size), "chunk int, part int, cells binary")
    often = cells.groupBy("part").applyInArrow(_often_in(size), ANSWER)
    keys = by_chunk.cogroup(often.groupBy("chunk")).applyInArrow(_keys_of(size), "chunk int, part int, one binary, two binary, ids binary")
    earlier = keys.groupBy("part").applyInArrow(_earlier, ANSWER)
    answers = often.unionByName(earlier).groupBy("chunk")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in typed.schema]
    return by_chunk.cogroup(answers).applyInArrow(_cut(size, names), ", ".join([*fields, "n_words long", "n_removed long"]))
