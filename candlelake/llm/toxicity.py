"""Toxicity of documents by compression distance.

Two zstandard dictionaries are made: one trained on ordinary text, one of the words that toxic text has and ordinary
text has not (a toxic text is ordinary for the most part). A window is compressed with the first, and with both together;
the bytes that the toxic dictionary saves, compared over all windows, are calibrated to a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlelake.llm.compression import Fitted, compressors, fit_calibration, labelled_sample, lengths, scored, trained

ORDINARY, WINDOW, OVERLAP, LEVEL = 65_536, 128, 16, 9
#: Bytes that a window must save to count.
SAVED = 3
#: A word is distinctive if toxic texts have it so much more often than ordinary ones, and if fewer than so many words
#: would be found by chance.
TIMES, BY_CHANCE = 4.0, 0.05
#: Words on each side of a word: with neighbours that an earlier text has, it is a copy. An edit nearer than that hides it.
NEIGHBOURS = 3
TRAINING_WINDOWS = 20_000
CALIBRATION_SHARE = 3
#: Letters and digits, also with signs between them or a sign for the first letter.
WORDS = re.compile(rb"[@$]?[a-z0-9\x80-\xff]+(?:[-'@$*!_+#]+[a-z0-9\x80-\xff]+)*")


def windows(text: str) -> list[bytes]:
    """Overlapping windows over the lower-cased words."""
    line = b" " + b" ".join(WORDS.findall(text.lower().encode())) + b" "
    step = WINDOW - OVERLAP
    return [line[at : at + WINDOW] for at in range(0, max(1, len(line) - OVERLAP), step)]


def features(fitted: Fitted, text: str) -> np.ndarray:
    ordinary, both = compressors(fitted)
    parts = windows(text)
    a = lengths(ordinary, parts)
    saved = a - lengths(both, parts)
    top = np.sort(saved)[-3:]
    size = sum(map(len, parts))
    return np.array([saved.mean(), (saved >= SAVED).mean(), top.mean(), saved.max(), a.sum() / size])


def text_counts(texts: list[str]) -> Counter:
    """In how many texts each word occurs; a word between neighbours that an earlier text has is a copy of that one's."""
    import xxhash

    counts: Counter = Counter()
    seen: set[int] = set()
    for text in texts:
        words = WORDS.findall(text.lower().encode())
        own = {}
        for at, word in enumerate(words):
            near = xxhash.xxh64_intdigest(b" ".join(words[max(0, at - NEIGHBOURS) : at + NEIGHBOURS + 1]))
            own.setdefault(near, word)
        counts.update({word for near, word in own.items() if near not in seen})
        seen.update(own)
    return counts


def by_chance(toxic: int, texts: int, share: float) -> float:
    """A bound (Chernoff's) on the chance that ``toxic`` or more of ``texts`` are toxic where ``share`` of them should be."""
    found = toxic / texts
    if found <= share:
        return 1.0
    rest = (1 - found) * math.log((1 - found) / (1 - share)) if found < 1 else 0.0
    return math.exp(-texts * (found * math.log(found / share) + rest))


def distinctive(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """The words that far more toxic texts have than ordinary ones, the most frequent last.

    How often a word must occur follows from the number of words that are tested, not from a share of the texts. Texts are
    not told apart by language, so one that has four times its share of the toxic texts shows in its words.
    """
    if not toxic or not ordinary:
        return []
    plain, counts = text_counts(ordinary), text_counts(toxic)
    share = len(toxic) / (len(toxic) + len(ordinary))
    found = [
        word for word, n in counts.items()
        if (n + 0.5) * (1 - share) > TIMES * (plain[word] + 0.5) * share and by_chance(n, n + plain[word], share) * len(counts) < BY_CHANCE
    ]
    return sorted(found, key=lambda word: (counts[word], word))


def fit_texts(sample: dict[int, list[str]]) -> Fitted:
    """Fit on texts by label (1 toxic). Every third calibrates, the others make the dictionaries; that of toxic words
    holds all that were found."""
    calibrate = {k: texts[::CALIBRATION_SHARE] for k, texts in sample.items()}
    learn = {k: [t for i, t in enumerate(texts) if i % CALIBRATION_SHARE] for k, texts in sample.items()}
    plain = [w for t in learn[0] for w in windows(t)]
    step = max(1, len(plain) // TRAINING_WINDOWS)
    ordinary = trained(plain[::step], ORDINARY)
    toxic = b" ".join([b"", *distinctive(learn[1], learn[0]), b""])
    return fit_calibration((ordinary, ordinary + toxic), LEVEL, True, calibrate, features)


def fit(docs: DataFrame, labels: DataFrame, wanted: Column | None = None) -> Fitted:
    """Fit on a bounded sample of labelled documents (label column ``toxic``), of those ``wanted``."""
    return fit_texts(labelled_sample(docs, labels, "toxic", F.lit(True) if wanted is None else wanted))


def toxicity(text: Column, fitted: Fitted) -> Column:
    """A score from 0 to 1 of a whole text; null and empty texts get one and the same score."""
    return scored(text, fitted, features)
