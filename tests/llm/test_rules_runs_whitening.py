import hashlib
import math
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from llm_data import SMALL
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlelake.llm import periodic, queries, rules, whitening

# ---- host rules ---------------------------------------------------------------------------------------------------


def plain_measures(text):
    text = text or ""
    found, letters, symbols = [], 0, 0
    word = ""
    for letter in text + " ":
        if letter in " \t\n\v\f\r":
            if word:
                found.append(word)
            word = ""
        else:
            word += letter
            letters += 1
        symbols += letter in "#*$%&|<>"
    lines = [line for line in text.split("\n") if any(c not in " \t\n\v\f\r" for c in line)]
    windows = [tuple(found[k : k + 5]) for k in range(len(found) - 4)]
    times = Counter(windows)
    covered = {k + step for k, window in enumerate(windows) if times[window] > 1 for step in range(5)}
    return len(found), letters, symbols, sum(line in lines[:k] for k, line in enumerate(lines)), len(covered)


def test_measures_equal_a_plain_count(spark, small_docs, edge_docs):
    for docs in (small_docs, edge_docs):
        rows = docs.select("text", rules.measures(F.col("text")).alias("m")).collect()
        for row in rows:
            if len(row["text"] or "") > 100_000:
                assert row["m"]["n_words"] == len(row["text"].split())
                continue
            assert tuple(row["m"]) == plain_measures(row["text"])


def test_repeated_words_stay_exact_with_very_many_kinds_of_words():
    rnd = random.Random(1)
    long = [str(rnd.randrange(10**9)).encode() for _ in range(20_000)]
    assert rules.repeated_words(long) == 0
    assert rules.repeated_words(long + long[300:340]) == 80


def test_hosts_are_shrunk_by_how_much_they_differ(spark):
    rows = [("bad", k % 10 != 0) for k in range(200)] + [("good", k % 50 == 0) for k in range(200)]
    rows += [(f"small{k}", k % 9 == 0) for k in range(60)] + [(None, False), (None, True), ("lone", True)]
    docs = spark.createDataFrame([(k, *row) for k, row in enumerate(rows)], "doc_id long, host string, failed boolean")
    out = {r["doc_id"]: r for r in rules.host_rules(docs, F.col("host"), F.col("failed")).collect()}
    assert len(out) == len(rows)
    counts = Counter(h for h, _ in rows if h)
    failures = Counter(h for h, f in rows if h and f)
    n, k, hosts = sum(counts.values()), sum(failures.values()), len(counts)
    p = k / n
    spread = sum(counts[h] * (failures[h] / counts[h] - p) ** 2 for h in counts) / (p * (1 - p))
    g = (spread - (hosts - 1)) / (n - sum(c * c for c in counts.values()) / n - (hosts - 1))
    strength = max(2.0, 1 / g - 1)
    for doc_id, (host, failed) in enumerate(rows):
        row = out[doc_id]
        if host is None:
            assert row["host_rate"] is None and row["kept"] == (not failed)
            continue
        rate = (failures[host] + p * strength) / (counts[host] + strength)
        assert row["host_rate"] == pytest.approx(rate, rel=1e-12)
        assert row["kept"] == (not failed and rate <= 0.5)
    assert not any(out[d]["kept"] for d, (host, _) in enumerate(rows) if host == "bad")
    assert all(out[d]["kept"] for d, (host, failed) in enumerate(rows) if host == "good" and not failed)


def test_hosts_that_differ_by_chance_only_are_not_judged(spark):
    docs = spark.createDataFrame([(k, f"h{k % 40}", k % 4 == 0) for k in range(400)], "doc_id long, host string, failed boolean")
    counted = docs.groupBy("host").agg(F.count("*").alias("n_docs"), F.count_if("failed").alias("n_failed"))
    even = counted.withColumn("n_failed", F.lit(2).cast("long"))
    assert rules.fitted_prior(even) == rules.Prior(0.2, None)
    assert rules.fitted_prior(counted.where("false")).strength is None
    assert rules.fitted_prior(counted.withColumn("n_failed", F.lit(0).cast("long"))) == rules.Prior(0.0, None)


def test_rules_of_edge_rows(spark, edge_docs, no_docs):
    rows = rules.judge(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 10)
    assert rules.judge(no_docs).collect() == []
    bare = rules.judge(edge_docs.select("doc_id", "text")).collect()
    assert {r["host_docs"] for r in bare} == {None} and any(r["kept"] for r in bare)


# ---- periodic runs ------------------------------------------------------------------------------------------------


def plain_runs(words):
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        at = 0
        while at + q < n:
            start = at
            while at + q < n and words[at] == words[at + q]:
                at += 1
            end = at + q
            if at > start and end - start >= max(24, 3 * q):
                if not any(all(words[k] == words[k + d] for k in range(start, end - d)) for d in range(1, q)):
                    found.append((start, end - start, q))
            at += at == start
    return sorted(found, key=lambda run: (run[0], run[2]))


def test_runs_equal_brute_force_on_nested_and_broken_periods():
    rnd, total = random.Random(3), 0
    for _ in range(400):
        text = []
        while len(text) < rnd.randint(0, 300):
            kinds = rnd.choice([1, 2, 3, 50])
            block = [rnd.randint(0, kinds) for _ in range(rnd.randint(1, rnd.choice([2, 5, 20, 60])))]
            if rnd.random() < 0.4:
                block = (block * rnd.randint(2, 30))[: rnd.randint(1, 90)]
            text += (block * rnd.randint(1, 8))[: rnd.randint(1, 300)]
            if rnd.random() < 0.2:
                text[rnd.randrange(len(text))] = 99
        wanted = plain_runs(text)
        assert periodic.find_runs(np.array(text, dtype=np.int64)) == wanted
        total += len(wanted)
    assert total > 300


def test_one_word_a_million_times_is_one_run():
    assert periodic.find_runs(np.zeros(1_000_000, dtype=np.int64)) == [(0, 1_000_000, 1)]


def contract_rows(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()
    kept = b" ".join(w for k, w in enumerate(words) if k not in dropped)
    shas = [hashlib.sha256(x).hexdigest() for x in (lines, kept)]
    shown = [None] * 4 if best is None else [*best, math.floor(Fraction(1000 * best[1], best[2]))]
    return (doc_id, len(runs), *shown, *shas)


def test_op13_equals_a_plain_computation(spark, small_docs, tmp_path):
    found = sorted(map(tuple, queries.op13_runs(spark, SMALL).collect()))
    texts = [r for r in small_docs.select("doc_id", "text").collect()]
    wanted = {r["doc_id"]: contract_rows(r["doc_id"], r["text"]) for r in texts if len((r["text"] or "").split()) < 700}
    assert len(wanted) > 100 and len(found) == len(texts)
    assert {r[0]: r for r in found if r[0] in wanted} == wanted
    assert sum(r[1] > 0 for r in found) > 5


def test_op13_of_edge_rows(spark, edge_docs, no_docs, tmp_path):
    for name, docs in (("edges", edge_docs.where("length(text) < 5000 OR text IS NULL")), ("none", no_docs)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found = Counter(map(tuple, queries.op13_runs(spark, f"{tmp_path}/{name}").collect()))
        assert found == Counter(contract_rows(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect())
    long = edge_docs.where("length(text) > 5000").select(periodic.periodic(F.col("text")).alias("p"), "doc_id").collect()
    runs = {r["doc_id"]: [tuple(x) for x in r["p"]["runs"]] for r in long}
    assert runs == {7: [], 8: [(0, 30_000, 1)]}


# ---- whitening ----------------------------------------------------------------------------------------------------


def random_orthogonal(n, seed):
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))[0]


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(64, 1, 64), np.logspace(0, -9, 64), np.r_[np.full(20, 5.0), np.linspace(4, 1, 20)],
        np.r_[3.0, 2.0, np.zeros(30)], np.ones(40), np.array([4.0]), np.r_[1.0, 1 - 1e-9, 0.5, 1e-20],
    ],
)
def test_feast_finds_the_greatest_components(values):
    q = random_orthogonal(len(values), 5)
    matrix = (q * values) @ q.T
    e, u = whitening.principal((matrix + matrix.T) / 2)
    k = min(16, int((values > 1e-11).sum()))
    assert len(e) == k
    assert np.abs(e - np.sort(values)[::-1][:k]).max() < 1e-13 * values.max()
    assert np.abs(u.T @ u - np.eye(k)).max() < 1e-12
    assert np.linalg.norm(matrix @ u - u * e, axis=0).max() < 1e-12 * values.max()


def test_inertia_counts_what_lies_above_a_shift():
    values = np.r_[np.arange(12.0), 5.0, 5.0]
    q = random_orthogonal(len(values), 2)
    above = whitening.inertia(*whitening.tridiagonal((q * values) @ q.T))
    for shift in (-0.5, 0.5, 4.5, 5.5, 10.5, 11.5):
        assert above(shift) == (values > shift).sum()


def test_op12_equals_a_dense_computation(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    x = {r["vec_id"]: [math.floor(64.0 * c) + 1_000_000 for c in r["embedding"]] for r in rows}
    distinct = sorted({tuple(v) for v in x.values()})
    n, d = len(distinct), len(distinct[0])
    sums = [sum(v[j] for v in distinct) for j in range(d)]
    centred = np.array([[n * a - s for a, s in zip(v, sums, strict=True)] for v in distinct], dtype=float) / n
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    found = queries.op12_whitening(spark, SMALL).collect()
    assert len(found) == 16 * len(rows) == len({(r["vec_id"], r["component"]) for r in found})
    white = np.zeros((len(rows), 16))
    place = {vec_id: k for k, vec_id in enumerate(x)}
    for r in found:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x[r["vec_id"]], sums, strict=True))
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-10)
        white[place[r["vec_id"]], r["component"] - 1] = r["whitened"]
    exact = (np.array([x[v] for v in place], dtype=float) - np.array(sums) / n) @ u[:, :16] / np.sqrt(e[:16])
    exact *= np.sign((exact * white).sum(axis=0))
    assert np.abs(exact - white).max() < 1e-7


VECTOR = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("x", T.StringType())])


def test_whitening_of_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(k, [float(k % 3), float(k), 1.0], "c") for k in range(9)]
    rows = [*good, (1, [1.0, 1.0, 1.0], "c"), (None, [5.0, 2.0, 1.0], None), (20, None, "c"), (21, [], "c")]
    rows += [(22, [None, 1.0, 1.0], "c"), (23, [nan, 1.0, 1.0], "c"), (24, [inf, 1.0, 1.0], "c"), (25, [1.0], "c"), (26, [1e30, 1.0, 1.0], "c")]
    found = whitening.whiten(spark.createDataFrame(rows, VECTOR)).collect()
    # The third dimension does not vary, so there are two components; vector 1 comes twice, and once in the fit.
    assert Counter(r["vec_id"] for r in found) == Counter({None: 2, 1: 4, **{k: 2 for k in range(9) if k != 1}})
    assert {r["n"] for r in found} == {10}
    assert max(r["identity_error"] for r in found) < 1e-12
    for few in ([], rows[11:13], good[:1], [(k, [1.0, 2.0], "c") for k in range(5)]):
        assert whitening.whiten(spark.createDataFrame(few, VECTOR)).collect() == []


def test_deviations_beyond_a_long_are_null():
    fitted = whitening.Whitening(3, (3_000_000, 3_000_000), np.zeros(0), np.zeros((2, 0)), 0.0, 0.0)
    assert fitted.deviations(np.array([[1_000_064, 1_000_000]])) == [(3 * 64) ** 2]
    far = np.array([[1_000_064, 2**50], [1_000_064, 1_000_001]])
    assert fitted.deviations(far) == [None, (3 * 64) ** 2 + 9]
