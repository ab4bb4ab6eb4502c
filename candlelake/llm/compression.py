"""What the compression classifiers share: a bounded sample of labelled texts, dictionaries, lengths, calibration."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.llm.common import worker_store

#: Bounds of the labelled sample that a classifier is fitted on.
SAMPLE_ROWS, SAMPLE_BYTES_PER_TEXT = 3000, 20_000
RIDGE, STEPS, STEEPEST = 0.1, 50, 30.0


@dataclass(frozen=True)
class Fitted:
    """Dictionaries, their compression level, whether they are plain content, and the calibration."""

    dictionaries: tuple[bytes, ...]
    level: int
    plain: bool
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, wanted: Column, rows: int = SAMPLE_ROWS) -> list[Row]:
    """Rows (label, text) of labels 0 and 1: at most ``rows`` labelled ids each, those with the smallest hashes.

    Only ids where ``wanted`` holds are used; texts longer than ``SAMPLE_BYTES_PER_TEXT`` are left out, and equal
    texts of a label count once. Where ids are repeated with other texts, each label keeps the ``2 * rows`` texts with the
    smallest hashes, so many texts of one id take no room from the other label. The sample, not the corpus, reaches the
    driver: 240 MB at most, 120 MB where ids are not repeated.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where(wanted & F.col("doc_id").isNotNull() & F.col("label").isin(0, 1)).distinct()
    key = F.xxhash64("doc_id")
    chosen = [known.where(F.col("label") == k).orderBy(key, "doc_id").limit(rows) for k in (0, 1)]
    # Bounded by twice ``rows`` ids.
    ids = F.broadcast(chosen[0].unionByName(chosen[1]).withColumnRenamed("doc_id", "__id"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    short = own.where(F.octet_length("text") <= SAMPLE_BYTES_PER_TEXT)
    found = short.join(ids, F.col("doc_id") == F.col("__id")).select("label", "text").distinct()
    bounded = [found.where(F.col("label") == k).orderBy(F.xxhash64("text"), "text").limit(2 * rows) for k in (0, 1)]
    return sorted(bounded[0].unionByName(bounded[1]).collect(), key=lambda r: (r["label"], r["text"]))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, wanted: Column, rows: int = SAMPLE_ROWS) -> dict[int, list[str]]:
    """Texts of ``labelled_rows`` by label."""
    found = labelled_rows(docs, labels, label, wanted, rows)
    return {k: [r["text"] for r in found if r["label"] == k] for k in (0, 1)}


def trained(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary of the samples; where they are too few to train one, the samples themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


def compressors(fitted: Fitted) -> list[Callable[[bytes], bytes]]:
    """The worker's compressors for these dictionaries, made once."""
    import zstandard

    key, kept = (fitted.dictionaries, fitted.level, fitted.plain), worker_store("compressors")
    if key not in kept:
        made = []
        for content in fitted.dictionaries:
            plain = fitted.plain or content[:4] != b"\x37\xa4\x30\xec"
            kind = zstandard.DICT_TYPE_RAWCONTENT if plain else zstandard.DICT_TYPE_FULLDICT
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=kind) if content else None
            if dictionary:
                dictionary.precompute_compress(level=fitted.level)
            flags = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
            made.append(zstandard.ZstdCompressor(level=fitted.level, dict_data=dictionary, **flags).compress)
        kept.clear()
        kept[key] = made
    return kept[key]


def lengths(compress: Callable[[bytes], bytes], windows: list[bytes]) -> np.ndarray:
    return np.array([len(compress(w)) for w in windows], dtype=float)


def calibrated(features: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centre, spread and weights of a ridge logistic regression, by Newton's steps."""
    centre, spread = features.mean(axis=0), features.std(axis=0) + 1e-9
    x = np.column_stack([np.ones(len(features)), (features - centre) / spread])
    weights = np.zeros(x.shape[1])
    ridge = RIDGE * np.diag([0.01] + [1.0] * (x.shape[1] - 1))
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -STEEPEST, STEEPEST)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge
        step = np.linalg.solve(hessian, x.T @ (p - labels) + ridge @ weights)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return centre, spread, weights


def probability(fitted: Fitted, features: np.ndarray) -> float:
    raw = fitted.weights[0] + ((features - fitted.centre) / fitted.spread) @ fitted.weights[1:]
    return float(1 / (1 + np.exp(-np.clip(raw, -STEEPEST, STEEPEST))))


def scored(text: Column, fitted: Fitted, features: Callable[[Fitted, str], np.ndarray]) -> Column:
    """The calibrated score of each whole text; null is as empty."""

    @F.arrow_udf(T.DoubleType())
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([probability(fitted, features(fitted, t.as_py() or "")) for t in batch], pa.float64())

    return score(text.cast("string"))


def fit_calibration(
    dictionaries: tuple[bytes, ...], level: int, plain: bool, sample: dict[int, list[str]], features: Callable[[Fitted, str], np.ndarray]
) -> Fitted:
    """Calibrate on the texts that the dictionaries have not seen; without both labels, a score of the labels' share."""
    none = np.zeros(0)
    bare = Fitted(dictionaries, level, plain, none, none, none)
    rows = [(features(bare, t), k) for k in (0, 1) for t in sample[k]]
    if not rows or len({k for _, k in rows}) < 2:
        n = len(features(bare, ""))
        share = (len(sample[1]) + 0.5) / (len(rows) + 1)
        weights = np.concatenate([[np.log(share / (1 - share))], np.zeros(n)])
        return Fitted(dictionaries, level, plain, np.zeros(n), np.ones(n), weights)
    centre, spread, weights = calibrated(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float))
    return Fitted(dictionaries, level, plain, centre, spread, weights)
