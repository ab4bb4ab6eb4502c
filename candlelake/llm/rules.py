"""Quality rules of documents and of their hosts.

Each document is measured and held against its own rules. The failures are then counted by host (its domain; where a
corpus has none, its source), and the failure rates of hosts are shrunk towards the rate of all: a beta prior, fitted to
the hosts themselves, tells how much a host of few documents is to be believed. A document of a host whose shrunk rate
is over a half is dropped even if its own measures pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.llm.common import small, stored

# Rules of a document, and the characters that count as symbols.
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"
#: A host fails if more of its documents than this fail, by its shrunk rate.
MOST_FAILED = 0.5
#: The prior weighs no less than this many documents, so a host of one document never condemns itself.
LEAST_STRENGTH = 2.0

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURE_TYPE = T.StructType([T.StructField(name, T.LongType()) for name in MEASURES])
HOST = "__host"


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> int:
    """Words that lie in a stretch of ``window`` words which the text has twice or more, the first one included."""
    if len(words) <= window:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.array([seen.setdefault(word, len(seen)) for word in words], dtype=np.int64)
    keys, kinds = ids, len(seen)
    for step in range(1, window):
        # Numbers of stretches stay exact: they are renumbered before they could leave 63 bits.
        if kinds * len(seen) >= 1 << 62:
            kept, keys = np.unique(keys, return_inverse=True)
            kinds = len(kept)
        keys, kinds = keys[:-1] * len(seen) + ids[step:], kinds * len(seen)
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(keys), dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.flatnonzero(twice)
    edges[at] += 1
    edges[at + window] -= 1
    return int(np.count_nonzero(np.cumsum(edges)))


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def measured(text: str) -> tuple[int, ...]:
    """``MEASURES`` of a whole text."""
    data = text.encode()
    words = data.split()
    letters = len(text) - sum(map(data.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
    return len(words), letters, len(data) - len(data.translate(None, SYMBOLS)), repeated_lines(data), repeated_words(words)


def measures(text: Column) -> Column:
    """A struct of ``MEASURES`` for each whole text; null is as empty, all zero."""

    @F.arrow_udf(MEASURE_TYPE)
    def measure(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [measured(value.as_py() or "") for value in batch]
            columns = zip(*rows, strict=True) if rows else [()] * len(MEASURES)
            yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], list(MEASURES))

    return measure(text.cast("string"))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words)


@dataclass(frozen=True)
class Prior:
    """The beta distribution of hosts' failure rates: its mean, and how many documents it weighs (None: any number)."""

    mean: float
    strength: float | None

    def shrunk(self, failed: Column, docs: Column) -> Column:
        """The expected failure rate of a host after its documents are seen."""
        if self.strength is None:
            return F.lit(self.mean)
        return (failed + F.lit(self.mean * self.strength)) / (docs + F.lit(self.strength))


def fitted_prior(hosts: DataFrame, docs: str = "n_docs", failed: str = "n_failed") -> Prior:
    """The prior by the method of moments, from one row of sums over the hosts.

    With rates r of hosts of n documents, N in all, mean p, the spread sum(n (r - p)^2) of beta-binomial counts is
    expected at p (1 - p) (H - 1 + g (N - sum(n^2) / N - (H - 1))), where H counts hosts and 1 / g - 1 is the strength.
    Hosts that differ no more than by chance give ``strength`` None, which shrinks each to the mean.
    """
    n, k = F.col(docs).cast("double"), F.col(failed).cast("double")
    row = hosts.agg(
        F.count(F.lit(1)).alias("hosts"), F.sum(n).alias("n"), F.sum(k).alias("k"),
        F.sum(n * n).alias("nn"), F.sum(k * k / n).alias("kk"),
    ).first()
    if not row["n"]:
        return Prior(0.0, None)
    mean = row["k"] / row["n"]
    within = mean * (1 - mean)
    free = row["n"] - row["nn"] / row["n"] - (row["hosts"] - 1)
    if not within or free <= 0:
        return Prior(mean, None)
    between = ((row["kk"] - row["n"] * mean * mean) / within - (row["hosts"] - 1)) / free
    if between <= 0:
        return Prior(mean, None)
    return Prior(mean, max(LEAST_STRENGTH, 1 / min(1.0, between) - 1))


def host_rules(docs: DataFrame, host: Column, failed: Column, most_failed: float = MOST_FAILED) -> DataFrame:
    """``docs`` with ``host_docs``, ``host_failures``, ``host_rate`` (shrunk) and ``kept``.

    ``failed`` is a document's own verdict, null being as failed. A document is kept if it did not fail and its host's
    shrunk rate is ``most_failed`` at most. A document without a host is judged by its own verdict, its host columns are
    null. Give ``docs`` as stored rows: it is read twice. Hosts are aggregated before the shuffle, so a host with a third
    of all documents is one row per task; their table is broadcast if a count proves it small, else AQE splits a hot host
    of the join.
    """
    added = ("host_docs", "host_failures", "host_rate", "kept")
    carried = [F.col(f"`{c}`") for c in docs.columns if c not in (*added, HOST)]
    own = docs.select(*carried, F.coalesce(failed, F.lit(True)).alias("__failed"), host.cast("string").alias(HOST))
    counted = own.where(F.col(HOST).isNotNull()).groupBy(HOST).agg(
        F.count(F.lit(1)).alias("n_docs"), F.count_if("__failed").alias("n_failed")
    )
    counted = stored(counted)
    prior = fitted_prior(counted)
    hosts = counted.select(
        F.col(HOST).alias("__of"), F.col("n_docs").alias("host_docs"), F.col("n_failed").alias("host_failures"),
        prior.shrunk(F.col("n_failed"), F.col("n_docs")).alias("host_rate"),
    )
    joined = own.join(small(hosts, "__of"), F.col(HOST) == F.col("__of"), "left")
    bad_host = F.coalesce(F.col("host_rate") > most_failed, F.lit(False))
    return joined.withColumn("kept", ~F.col("__failed") & ~bad_host).drop(HOST, "__of", "__failed")


def judge(docs: DataFrame, host: Column | None = None, most_failed: float = MOST_FAILED) -> DataFrame:
    """All documents (``doc_id``, ``text``) with ``MEASURES``, ``base_failed``, their host's counts and rate, and ``kept``.

    ``host`` is the column ``source`` by default; for pages give ``F.parse_url("url", F.lit("HOST"))``. A null or empty
    text has no words and fails; repeated rows are judged each, and count each for their host. Other columns are left
    out. Texts are read once; what is measured of them is stored in the shared folder and joined with the hosts.
    """
    if host is None:
        host = F.col("source") if "source" in docs.columns else F.lit(None)
    found = docs.select("doc_id", host.cast("string").alias(HOST), measures(F.col("text")).alias("__m"))
    rows = stored(found.select("doc_id", HOST, "__m.*"))
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    return host_rules(rows.withColumn("base_failed", failed), F.col(HOST), F.col("base_failed"), most_failed)
