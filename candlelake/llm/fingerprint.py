"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range. What is kept of a text does not depend
on its length or on other texts, so sketches of parts merge by union, and the share of one sketch found in another
estimates containment even between very unequal documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.llm.common import ordered_chunks

SHINGLE, FRACTION, HASH_BITS = 5, 2, 48
DIGITS = HASH_BITS // 4
ROWS_PER_CHUNK = 4096

COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, contained_edited double, contained_next double"
)


def sketched(text: str) -> tuple[np.ndarray, int | None]:
    """The sketch: sorted hashes of the lower-cased five-word shingles below half the range of 48 bits.

    Fewer words are one shingle. A text of few shingles may have no hash there: then, beside its empty sketch, its
    smallest hash is given, which tells it from other such texts but is no part of the sketch. No words give neither.
    """
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64), None
    parts = zip(*(words[k:] for k in range(SHINGLE)), strict=False) if len(words) >= SHINGLE else [words]
    raw = b"".join(map(xxhash.xxh64_digest, map(b" ".join, parts)))
    hashes = np.frombuffer(raw, dtype=">u8").astype(np.uint64) >> np.uint64(64 - HASH_BITS)
    kept = np.unique(hashes[hashes < np.uint64((1 << HASH_BITS) // FRACTION)])
    return kept, None if len(kept) else int(hashes.min())


def sketch(text: str) -> np.ndarray:
    return sketched(text)[0]


def written(hashes: np.ndarray, alone: int | None = None) -> str:
    """A sketch as text: twelve hexadecimal digits a hash, ascending; the smallest hash of an empty sketch after a minus."""
    return f"-{alone:0{DIGITS}x}" if alone is not None else "".join(f"{h:0{DIGITS}x}" for h in hashes.tolist())


Sketch = tuple[np.ndarray, int | None]


def likeness(a: Sketch, b: Sketch) -> tuple[float, float | None]:
    """Estimated similarity (Jaccard) of two texts, and how much of the smaller sketch the larger one contains.

    Texts without a sketch are alike if their smallest hashes are, or if both have no words; what they contain cannot be
    told and is null, but for texts without words, whose like contains them.
    """
    (own, alone), (other, other_alone) = a, b
    if not len(own) or not len(other):
        same = len(own) == len(other) and alone == other_alone
        told = alone is None and other_alone is None
        return float(same), float(same) if told else None
    shared = len(np.intersect1d(own, other, assume_unique=True))
    return shared / (len(own) + len(other) - shared), shared / min(len(own), len(other))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _sketches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        yield pa.array([sketch(t.as_py() or "").astype(np.int64) for t in batch], pa.list_(pa.int64()))


def fingerprint(text: Column) -> Column:
    """The sketch of a whole text, ascending; null is as empty."""
    return _sketches(text.cast("string"))


def merged(sketches: Column) -> Column:
    """Aggregate: the sketch of all texts together."""
    return F.sort_array(F.array_distinct(F.flatten(F.collect_set(sketches))))


def containment(part: Column, whole: Column) -> Column:
    """Estimated share of ``part`` that ``whole`` contains; null where the part has no hash to tell it by."""
    return F.when(F.size(part) > 0, F.size(F.array_intersect(part, whole)) / F.size(part))


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, of one chunk and then of the row after it: compare each with the next and with its own edit."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ("contained_edited", pa.float64()), ("contained_next", pa.float64()),
    ])
    before, ended = None, False
    for batch in batches:
        rows = []
        for doc_id, text, ahead in zip(*(batch.column(i) for i in range(3)), strict=True):
            if ended:
                break
            text = text.as_py() or ""
            hashes = sketched(text)
            if before is not None:
                own_id, own, own_hashes = before
                gone = len(own) // 2
                edited = own[: len(own) - gone] + text[:gone]
                edited_hashes = sketched(edited)
                near, near_next = likeness(own_hashes, edited_hashes), likeness(own_hashes, hashes)
                digest = hashlib.sha256(edited.encode()).hexdigest()
                prints = written(*own_hashes), written(*edited_hashes)
                rows.append((own_id, len(own), digest, *prints, near[0], near_next[0], near[1], near_next[1]))
            before, ended = (doc_id.as_py(), text, hashes), ahead.as_py()
        columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def compare_with_next(docs: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Fingerprints of each whole text and of its edit, in which the next document's start replaces the second half.

    The next document is that of the next id, nulls last; after the last comes the first; equal ids are in order of a
    hash of their text. A null text is empty. Chunks of (id, hash of text) are sorted on their own; the first row of each
    is also sent to the chunk before, so a chunk streams through one task, two texts at a time. Rows without an id and
    rows of one id are cut into chunks like others. No rows give no rows.
    """
    typed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    chunked, n = ordered_chunks(typed, rows_per_chunk, "chunk")
    tie = F.xxhash64("text").alias("tie")
    # One row per chunk: its first pair of id and hash. The chunk before needs a row of that pair too.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", tie)).alias("first")
    heads = chunked.groupBy("chunk").agg(first).select("chunk", "first.doc_id", "first.tie").orderBy("chunk").collect()
    needed = [(head["doc_id"], head["tie"], heads[k - 1]["chunk"]) for k, head in enumerate(heads)]
    ahead = F.broadcast(docs.sparkSession.createDataFrame(needed, "head long, head_tie long, to int"))
    found = typed.join(ahead, F.col("doc_id").eqNullSafe(F.col("head")) & (F.xxhash64("text") == F.col("head_tie")))
    # Rows equal in id and text are one text.
    after = found.groupBy("to").agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"))
    rows = chunked.select("doc_id", "text", F.lit(False).alias("ahead"), F.col("chunk").alias("to"))
    sent = rows.unionByName(after.select("doc_id", "text", F.lit(True).alias("ahead"), "to"))
    laid = sent.repartitionById(n, F.col("to")).sortWithinPartitions("ahead", F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))
    return laid.select("doc_id", "text", "ahead").mapInArrow(_with_next, COMPARED)
