"""Pack documents into sequences of a fixed length by the histogram of their piece lengths.

Documents are cut into full pieces and one rest; only lengths matter for the packing, so it runs on a histogram of
at most ``length`` bins: longest lengths first, each into the packs with the most room left, as many at once as both
counts allow. The resulting patterns are joined back to the pieces by a piece's rank among those of its length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlelake.llm.common import number_rows, stored
from candlelake.llm.tokens import encoder

END_ID = 0
ROWS_AT_ONCE = 256


def squeezed(ids: bytes, compress: Callable[[bytes], bytes]) -> bytes:
    """Ids as they travel between tasks: their width in bytes, and the compressed ids in that width."""
    numbers = np.frombuffer(ids, dtype="<u4")
    width = 2 if int(numbers.max(initial=0)) < 1 << 16 else 4
    return bytes([width]) + compress(numbers.astype(f"<u{width}").tobytes())


def widened(data: bytes, decompress: Callable[[bytes], bytes]) -> bytes:
    return np.frombuffer(decompress(data[1:]), dtype=f"<u{data[0]}").astype("<u4").tobytes()


def token_pieces(docs: DataFrame, tokenizer: str, length: int = 1024, *, with_ids: bool = True, squeeze: bool = False) -> DataFrame:
    """Pieces of at most ``length`` ids: (doc_id, start, length, ids_crc32, doc_tokens[, ids]).

    A document's ids are those of its whole text (null: empty) and an end id, so every document has a piece; a null
    id or repeated rows are pieces like others. ``ids`` are little-endian unsigned 32-bit numbers, or
    ``squeezed`` ones.
    """
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())]
    schema = pa.schema(fields + [("ids", pa.binary())] * with_ids)
    end, step = np.array([END_ID], dtype="<u4").tobytes(), 4 * length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encode, compress = encoder(tokenizer), zstandard.ZstdCompressor(level=1).compress
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + end
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    kept = squeezed(piece, compress) if squeeze else piece
                    rows.append((doc_id, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, kept))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=False)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    spark_schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, spark_schema)


def shortest_pack_first(histogram: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of piece lengths with their counts. Lengths go longest first into the packs with the most room."""
    room: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        moved: dict[tuple[int, ...], int] = defaultdict(int)
        for space in range(length, size - 1, -1):
            packs = room[space]
            while left and packs:
                pattern, count = packs.popitem()
                taken = min(left, count)
                if count > taken:
                    packs[pattern] = count - taken
                moved[(*pattern, size)] += taken
                left -= taken
            if not left:
                break
        if left:
            moved[(size,)] += left
        for pattern, count in moved.items():
            packs = room[length - sum(pattern)]
            packs[pattern] = packs.get(pattern, 0) + count
    return sorted((pattern, count) for packs in room.values() for pattern, count in packs.items())


def intervals(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length, rows of (first rank, first sequence, offset) in order of ranks: who of that length goes where."""
    ranks: dict[int, int] = defaultdict(int)
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    sequence = 0
    for pattern, count in patterns:
        offset = 0
        for size in pattern:
            rows[size].append((ranks[size], sequence, offset))
            ranks[size] += count
            offset += size
        sequence += count
    return {size: np.array(found, dtype=np.int64) for size, found in rows.items()}


def pack_pieces(pieces: DataFrame, length: int = 1024) -> DataFrame:
    """Pieces (doc_id, start, length, ...) with ``sequence_id`` and ``offset``.

    Pieces are numbered in order of (length, doc_id, start, all other orderable columns), so pieces of one length
    follow each other over as many tasks as they need, and a piece's rank is its number less the number of shorter
    pieces. The histogram has ``length`` bins at most and its patterns a few thousand, whatever the input; they are
    all that the driver sees. Ties are interchangeable. No pieces give no rows; longer pieces are an error.
    """
    order = ["length", "doc_id", "start", *[c for c in pieces.columns if c not in ("length", "doc_id", "start", "ids")]]
    numbered = number_rows(pieces, [F.col(c) for c in order], "piece_number")
    counts = {int(r["length"]): r["count"] for r in numbered.groupBy("length").count().collect()}
    if counts and not 0 < min(counts) <= max(counts) <= length:
        raise ValueError(f"lengths of pieces must lie between 1 and {length}")
    before, total = {}, 0
    for size in sorted(counts):
        before[size] = total
        total += counts[size]
    table = intervals(shortest_pack_first(counts, length))
    own = numbered.columns
    at_length, at_number = own.index("length"), own.index("piece_number")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, numbers = batch.column(at_length).to_numpy(), batch.column(at_number).to_numpy()
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for size in np.unique(sizes):
                chosen = sizes == size
                rows, rank = table[int(size)], numbers[chosen] - before[int(size)]
                found = rows[np.searchsorted(rows[:, 0], rank, side="right") - 1]
                sequence[chosen] = found[:, 1] + rank - found[:, 0]
                offset[chosen] = found[:, 2]
            arrays = [c for i, c in enumerate(batch.columns) if i != at_number]
            names = [c for c in own if c != "piece_number"]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "piece_number"]
    return numbered.mapInArrow(place, ", ".join([*fields, "sequence_id long", "offset long"]))


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence with its ids, from pieces packed ``with_ids``: a group holds one sequence's ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    return packed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("n_tokens"))


def pack_documents(docs: DataFrame, tokenizer: str, length: int = 1024, *, with_ids: bool = True) -> DataFrame:
    """Tokenize, cut and pack whole documents; the pieces are stored once, so no text is tokenized twice.

    With ids, the pieces of a sequence follow each other in order of ``offset`` in one partition, so their ids in a row
    are the sequence. Only numbers are sorted for the packing: the ids stay where they are, squeezed, until the
    places are known.
    """
    cut = token_pieces(docs, tokenizer, length, with_ids=with_ids, squeeze=True)
    if not with_ids:
        return pack_pieces(stored(cut), length)
    pieces = stored(cut.withColumn("__piece", F.monotonically_increasing_id()))
    placed = pack_pieces(pieces.drop("ids"), length).join(pieces.select("__piece", "ids"), "__piece")
    names = [*cut.columns, "sequence_id", "offset"]
    laid = placed.select(*names).repartition("sequence_id").sortWithinPartitions("sequence_id", "offset")
    at_ids = names.index("ids")

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        decompress = zstandard.ZstdDecompressor().decompress
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            ids = pa.array([widened(x.as_py(), decompress) for x in batch.column(at_ids)], pa.binary())
            yield batch.set_column(at_ids, "ids", ids)

    return laid.mapInArrow(widen, laid.schema)
