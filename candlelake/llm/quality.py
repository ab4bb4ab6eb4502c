"""Quality of documents by compression: dictionaries of good and of bad text, and which of them shortens a text more."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.compression import Fitted, compressors, fit_calibration, labelled_sample, lengths, scored, trained

DICTIONARY, WINDOW, LEVEL = 65_536, 1024, 3
#: Every third text of a label calibrates, the others make its dictionary.
CALIBRATION_SHARE = 3


def windows(text: bytes) -> list[bytes]:
    return [text[at : at + WINDOW] for at in range(0, max(1, len(text)), WINDOW)]


def features(fitted: Fitted, text: str) -> np.ndarray:
    """Normalised differences of compressed sizes, of the whole text and of its windows, and how far it shrinks."""
    whole = text.encode()
    good, bad = compressors(fitted)
    a, b = len(good(whole)), len(bad(whole))
    parts = windows(whole)
    each_a, each_b = lengths(good, parts), lengths(bad, parts)
    difference, size = (each_a - each_b) / np.maximum(each_a, each_b), max(1, len(whole))
    shrunk = np.minimum(each_a, each_b).sum() / size
    return np.array([(a - b) / max(a, b), min(2.0, min(a, b) / size), difference.mean(), difference.max(), min(2.0, shrunk)])


def fit_texts(sample: dict[int, list[str]]) -> Fitted:
    """Fit on texts by label (0 bad, 1 good)."""
    parts = {k: (texts[::CALIBRATION_SHARE], [t for i, t in enumerate(texts) if i % CALIBRATION_SHARE]) for k, texts in sample.items()}
    made = tuple(trained([w for t in parts[k][1] for w in windows(t.encode())], DICTIONARY) for k in (1, 0))
    return fit_calibration(made, LEVEL, False, {k: parts[k][0] for k in (0, 1)}, features)


def fit(docs: DataFrame, labels: DataFrame, wanted: Column | None = None) -> Fitted:
    """Fit on a bounded sample of labelled documents (label column ``quality``: 1 good), of those ``wanted``."""
    return fit_texts(labelled_sample(docs, labels, "quality", F.lit(True) if wanted is None else wanted))


def quality(text: Column, fitted: Fitted) -> Column:
    """A score from 0 to 1 of a whole text, higher for better ones; null and empty texts get one and the same score."""
    return scored(text, fitted, features)
