"""Token ids in files of length-delimited binary records, with an index of offsets for shuffled reads.

A record is framed as: length of the payload (8 bytes), masked checksum of those 8 bytes (4), payload, masked
checksum of the payload (4); all little-endian. The checksum is CRC-32, turned right by 15 bits and shifted by a
constant. A payload has a document's id (8 bytes, and 1 byte that is 0 where the id is null), the width of its token
ids in bytes (1), and the ids. The index beside a file has each record's offset and number of ids (8 bytes each).
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.llm.common import ordered_chunks, stored
from candlelake.llm.tokens import encoder

END_ID = 1
#: Documents and bytes of a file at most (a document's record is never cut), and about how many documents a task gets.
ROWS_PER_FILE, FILE_BYTES, ROWS_PER_TASK = 4096, 1 << 26, 4096
FILE_BITS = 32
#: Fixed values of the usual masking of checksums in record files.
MASK_TURN, MASK_ADDED = 15, 0xA282EAD8
HEAD, CHECK, PREFIX, ENTRY = "<QI", "<I", "<qBB", "<QQ"
HEAD_BYTES, CHECK_BYTES, PREFIX_BYTES = 12, 4, 10

MANIFEST = "file long, path string, first_id long, n_records long, n_tokens long, n_bytes long"
RECORDS = "file long, record long, doc_id long, n_tokens long, before long, ids_crc32 long"


def masked(data: bytes) -> int:
    check = zlib.crc32(data)
    return ((check >> MASK_TURN | check << 32 - MASK_TURN) + MASK_ADDED) & 0xFFFFFFFF


def payload(doc_id: int | None, ids: np.ndarray) -> bytes:
    width = 2 if int(ids.max(initial=0)) < 1 << 16 else 4
    return struct.pack(PREFIX, doc_id or 0, doc_id is not None, width) + ids.astype(f"<u{width}").tobytes()


def framed(data: bytes) -> bytes:
    length = struct.pack("<Q", len(data))
    return length + struct.pack(CHECK, masked(length)) + data + struct.pack(CHECK, masked(data))


def read_record(data: bytes | memoryview, at: int = 0) -> tuple[int | None, np.ndarray, int]:
    """The document's id, its token ids (unsigned 32-bit), and where the next record begins."""
    size, check = struct.unpack_from(HEAD, data, at)
    body = at + HEAD_BYTES
    if masked(bytes(data[at : at + 8])) != check or body + size + CHECK_BYTES > len(data):
        raise ValueError(f"broken length of the record at byte {at}")
    part = bytes(data[body : body + size])
    if masked(part) != struct.unpack_from(CHECK, data, body + size)[0]:
        raise ValueError(f"broken content of the record at byte {at}")
    doc_id, known, width = struct.unpack_from(PREFIX, part)
    ids = np.frombuffer(part, f"<u{width}", offset=PREFIX_BYTES).astype("<u4")
    return doc_id if known else None, ids, body + size + CHECK_BYTES


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{os.path.abspath(path)}")


def _qualified(spark: SparkSession, path: str) -> str:
    """A path without a scheme is on the cluster's default file system, whatever the executors' own is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(place).toString()


def _write_whole(path: str, content: bytes) -> None:
    system, place = _filesystem(path)
    system.create_dir(os.path.dirname(place), recursive=True)
    with system.open_output_stream(place) as out:
        out.write(content)


def write_records(docs: DataFrame, path: str, tokenizer: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Encode whole texts (null: empty), append the end id, write files in ascending order of doc_id, nulls last.

    Returns the stored manifest, one row per file in order of ``file``. ``path`` is a folder that all executors
    reach, by any scheme that ``pyarrow.fs`` knows. Equal ids are in order of a hash of their text; repeated rows are
    repeated records. A task streams its range of documents and begins a new file after ``rows_per_file`` documents or
    ``FILE_BYTES``, whichever comes first, so no file and no task's memory grows with the table. Each attempt of a task
    writes under names of its own, and the manifest names those of the one that counted. No rows give an empty manifest.
    """
    path = _qualified(docs.sparkSession, path)
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chunked, n = ordered_chunks(typed, ROWS_PER_TASK, "range")
    laid = chunked.repartitionById(n, F.col("range")).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    schema = pa.schema([("file", pa.int64()), ("path", pa.string()), *((c, pa.int64()) for c in ("first_id", "n_records", "n_tokens", "n_bytes"))])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, attempt = encoder(tokenizer), uuid.uuid4().hex
        end = np.array([END_ID], dtype="<u4").tobytes()
        data, index, file, first, tokens = bytearray(), bytearray(), 0, None, 0

        def finished() -> pa.RecordBatch:
            number = (task << FILE_BITS) + file
            name = f"{path.rstrip('/')}/part-{task:06d}-{file:06d}-{attempt}.rec"
            _write_whole(name, bytes(data))
            _write_whole(f"{name}.idx", bytes(index))
            row = [number, name, first, len(index) // struct.calcsize(ENTRY), tokens, len(data)]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True))], schema=schema)

        for batch in batches:
            for doc_id, text, part in zip(*(batch.column(i) for i in range(3)), strict=True):
                doc_id, task = doc_id.as_py(), part.as_py()
                if len(index) >= rows_per_file * struct.calcsize(ENTRY) or len(data) >= FILE_BYTES:
                    yield finished()
                    data, index, file, tokens = bytearray(), bytearray(), file + 1, 0
                first = first if index else doc_id
                ids = np.frombuffer(encode(text.as_py() or "") + end, dtype="<u4")
                index += struct.pack(ENTRY, len(data), len(ids))
                data += framed(payload(doc_id, ids))
                tokens += len(ids)
        if index:
            yield finished()

    return stored(laid.mapInArrow(write, MANIFEST))


def read_index(path: str) -> np.ndarray:
    """Rows of (offset, number of ids) for a record file's path."""
    system, place = _filesystem(f"{path}.idx")
    with system.open_input_file(place) as source:
        return np.frombuffer(source.read(), dtype="<u8").reshape(-1, 2)


def read_at(path: str, number: int) -> tuple[int | None, np.ndarray]:
    """One record by its number in the file: its frame alone is read, as a shuffled reader does."""
    index = read_index(path)
    system, place = _filesystem(path)
    with system.open_input_file(place) as source:
        at = int(index[number, 0])
        end = int(index[number + 1, 0]) if number + 1 < len(index) else source.size()
        source.seek(at)
        return read_record(source.read(end - at))[:2]


def read_records(manifest: DataFrame) -> DataFrame:
    """All records of the manifest's files, checked: (file, record, doc_id, n_tokens, before, ids_crc32).

    ``before`` counts the ids of all records before, over all files; one row per file is all that meets in one task
    for it. ``ids_crc32`` is over the ids as little-endian unsigned 32-bit integers.
    """
    before = F.expr("coalesce(sum(n_tokens) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    files = manifest.select("file", "path", before.alias("before"))
    n = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, place = _filesystem(row["path"])
                with system.open_input_file(place) as source:
                    data = source.read()
                at, start, out = 0, row["before"], []
                while at < len(data):
                    doc_id, ids, at = read_record(data, at)
                    out.append((row["file"], len(out), doc_id, len(ids), start, zlib.crc32(ids.tobytes())))
                    start += len(ids)
                kinds = [pa.int64()] * 6
                names = ["file", "record", "doc_id", "n_tokens", "before", "ids_crc32"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return files.repartition(n).mapInArrow(read, RECORDS)
