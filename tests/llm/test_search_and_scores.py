import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
import zstandard
from llm_data import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candlelake.llm import ann, fingerprint, quality, queries, records, toxicity
from candlelake.llm.common import ordered_chunks, scratch
from candlelake.llm.compression import labelled_rows, probability

VECTORS = "vec_id long, embedding array<float>, label string, score string"


def plain_nearest(rows, query_id, query, k):
    scores = [(float(np.sqrt(((np.array(v, float) - np.array(query, float)) ** 2).sum())), i) for i, v in rows if i != query_id]
    return sorted(scores)[:k]


def test_recall_of_the_query(spark):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    found = {}
    for r in queries.QUERIES["op6_ann"](spark, SMALL).collect():
        found.setdefault(r["query_id"], []).append(r)
    asked = {i: v for i, v in rows if i % 100 == 0}
    assert set(found) == set(asked)
    hits = 0
    for query_id, got in found.items():
        got.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 11))
        assert [(r["score"], r["vec_id"]) for r in got] == sorted((r["score"], r["vec_id"]) for r in got)
        true = {i for _, i in plain_nearest(rows, query_id, asked[query_id], 10)}
        hits += len(true & {r["vec_id"] for r in got})
    assert hits >= 0.9 * 10 * len(found)


def test_cells_are_walked_in_order_of_their_summed_distance():
    rng = np.random.default_rng(11)
    for one, two in ((1, 1), (1, 7), (9, 1), (12, 15)):
        near, other = rng.random(one), rng.random(two)
        counts = rng.integers(0, 3, one * two)
        sums = (near[:, None] + other[None, :]).ravel()
        filled = [int(cell) for cell in np.argsort(sums) if counts[cell]]
        for wanted in (0, 1, 10, int(counts.sum()), int(counts.sum()) + 5):
            before = np.cumsum([0, *counts[filled]])[:-1]
            assert ann.visited(near, other, counts, wanted) == [c for c, n in zip(filled, before, strict=False) if n < wanted]


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    good = [(k, [float(k % 3), 1.0, 0.5 * (k % 2)]) for k in range(12)]
    bad = [(100, None), (200, [0.0, 0.0, 0.0]), (300, [1.0, None, 1.0]), (400, [nan, 1.0, 1.0]), (500, [inf, 1.0, 1.0]), (600, [1.0, 2.0]), (None, [1.0, 1.0, 1.0])]
    frame = spark.createDataFrame([(*r, "l", None) for r in good + bad + [good[4]]], VECTORS)
    found = ann.nearest(frame, frame.where("vec_id % 100 = 0 or vec_id = 4"), k=20, recall=1.0).collect()
    for query_id in (0, 4):
        got = sorted((r for r in found if r["query_id"] == query_id), key=lambda r: r["rank"])
        assert [(r["score"], r["vec_id"]) for r in got] == plain_nearest(good + [good[4]], query_id, dict(good)[query_id], 20)
    assert {r["query_id"] for r in found} == {0, 4}
    for vectors in (frame.limit(0), frame.where("vec_id = 0"), frame.where("vec_id >= 100")):
        assert ann.nearest(vectors, vectors).count() == 0
    line = spark.createDataFrame([(k, [float(k + 1)], None, None) for k in range(5)], VECTORS)
    assert [r["vec_id"] for r in ann.nearest(line, line.where("vec_id = 0")).orderBy("rank").collect()] == [1, 2, 3, 4]


def test_search_in_small_groups(spark):
    """One vector that many rows share, in groups of eight, loses nothing."""
    rows = [(k, [1.0, 2.0, 3.0, 4.0]) for k in range(40)] + [(k, [float(k), 1.0, float(k % 7), 2.0]) for k in range(40, 90)]
    frame = spark.createDataFrame([(*r, None, None) for r in rows], VECTORS)
    before = ann.BLOCK
    try:
        ann.BLOCK = 8
        found = ann.nearest(frame, frame, k=5, recall=1.0).collect()
    finally:
        ann.BLOCK = before
    same = [r for r in found if r["query_id"] < 40]
    assert len(same) == 200 and all(r["score"] == 0 for r in same)
    for query_id in (0, 39):
        assert [r["vec_id"] for r in sorted(same, key=lambda r: r["rank"]) if r["query_id"] == query_id] == [k for k in range(6) if k != query_id][:5]


def plain_sketch(text):
    """The hashes of all shingles, and of those below half the range: from the definition, without the library."""
    words = text.encode().lower().split()
    shingles = [b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))] if words else []
    hashes = {xxhash.xxh64_intdigest(s) >> 16 for s in shingles}
    return hashes, {h for h in hashes if h < 1 << 47}


def plain_print(text):
    hashes, kept = plain_sketch(text)
    return "".join(f"{h:012x}" for h in sorted(kept)) if kept or not hashes else f"-{min(hashes):012x}"


def plain_likeness(a, b):
    (all_a, a), (all_b, b) = plain_sketch(a), plain_sketch(b)
    if a and b:
        return len(a & b) / len(a | b), len(a & b) / min(len(a), len(b))
    same = not a and not b and min(all_a, default=None) == min(all_b, default=None)
    return float(same), float(same) if (not all_a or a) and (not all_b or b) else None


def test_fingerprints_with_next(spark, edge_docs, no_docs, small_docs):
    for docs, rows_per_chunk in ((small_docs, 17), (small_docs, 4096), (edge_docs.where("doc_id <> 1"), 3)):
        rows = sorted((r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect())
        found = {r["doc_id"]: r for r in fingerprint.compare_with_next(docs, rows_per_chunk).collect()}
        assert len(found) == len(rows)
        for k, (doc_id, text) in enumerate(rows):
            after = rows[(k + 1) % len(rows)][1]
            gone = len(text) // 2
            edited = text[: len(text) - gone] + after[:gone]
            r = found[doc_id]
            assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert (r["fingerprint"], r["edited_fingerprint"]) == (plain_print(text), plain_print(edited))
            assert (r["near_edited"], r["contained_edited"]) == plain_likeness(text, edited)
            assert (r["near_next"], r["contained_next"]) == plain_likeness(text, after)
    assert fingerprint.compare_with_next(no_docs).count() == 0


def test_rows_without_an_id_and_of_one_id_are_many_chunks(spark, edge_docs):
    texts = [(None if k % 3 else 7, f"text {k} of many", "x") for k in range(300)] + [(k, f"own text {k}", "x") for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, chunk string").unionByName(edge_docs.select("doc_id", "text", "chunk"))
    chunked, n = ordered_chunks(docs.select("doc_id", "text"), 20, "part")
    sizes = {r["part"]: (r["n"], r["missing"]) for r in chunked.groupBy("part").agg(F.count("*").alias("n"), F.count_if(F.col("doc_id").isNull()).alias("missing")).collect()}
    assert n >= 17 and max(k for k, _ in sizes.values()) <= 22 and sum(missing > 0 for _, missing in sizes.values()) >= 10
    rows = docs.select("doc_id", "text").collect()
    found = fingerprint.compare_with_next(docs, 20).collect()
    assert Counter(r["fingerprint"] for r in found) == Counter(plain_print(r["text"] or "") for r in rows)
    # Each text follows exactly one other: the edits take their ends from all of them.
    one = fingerprint.compare_with_next(docs, 4096).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, one))


def test_short_parts_of_long_texts_are_contained_or_unknown(spark):
    words = [f"v{k}" for k in range(400)]
    parts = [" ".join(words[k : k + 14]) for k in range(0, 380, 4)]
    found = [fingerprint.likeness(fingerprint.sketched(" ".join(words)), fingerprint.sketched(p))[1] for p in parts]
    assert set(found) <= {1.0, None} and found.count(1.0) > 0.97 * len(found)


def test_sketches_merge_and_contain(spark):
    text = " ".join(f"v{k}" for k in range(4000))
    part = " ".join(f"v{k}" for k in range(1000, 1600))
    frame = spark.createDataFrame([(1, text), (2, part), (3, None)], "doc_id long, text string")
    sketched = frame.select("doc_id", fingerprint.fingerprint(F.col("text")).alias("sketch"))
    whole = sketched.agg(fingerprint.merged(F.col("sketch")).alias("all"))
    got = {r["doc_id"]: r["c"] for r in sketched.crossJoin(whole).select("doc_id", fingerprint.containment(F.col("sketch"), F.col("all")).alias("c")).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: None}
    assert set(whole.first()["all"]) == set().union(*(plain_sketch(t)[1] for t in (text, part)))
    a, b = fingerprint.sketched(text), fingerprint.sketched(part)
    assert fingerprint.likeness(a, b)[1] == 1.0 and fingerprint.likeness(a, b)[0] == pytest.approx(0.15, abs=0.03)
    assert fingerprint.likeness(a, fingerprint.sketched(" ".join(f"u{k}" for k in range(500)))) == (0.0, 0.0)


@pytest.mark.parametrize(("name", "label", "by", "least"), [("op7_toxicity", "toxic", 5, 0.85), ("op10_quality", "quality", 3, 0.93)])
def test_held_out_accuracy(spark, name, label, by, least):
    folder = "/root/testdata/sf0.01"
    found = queries.QUERIES[name](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    rest = 0 if by == 5 else 1
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % by == rest) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["predicted"] == r[label] for r in held) >= least * len(held)


@pytest.mark.parametrize(("module", "label"), [(toxicity, "toxic"), (quality, "quality")])
def test_scores_of_edges(spark, edge_docs, no_docs, module, label):
    labels = spark.createDataFrame([(0, 1), (7, 1), (8, 0), (10, 0), (2, 0), (None, 1), (11, None), (12, 0)], f"doc_id long, {label} int")
    for known in (labels, labels.where(f"{label} = 1"), labels.limit(0)):
        fitted = module.fit(edge_docs, known)
        score = getattr(module, "toxicity" if label == "toxic" else "quality")(F.col("text"), fitted)
        scores = {r["text"]: r["s"] for r in edge_docs.select("text", score.alias("s")).collect()}
        assert all(0 <= s <= 1 for s in scores.values()) and scores[None] == scores[""]
    assert no_docs.select(score).count() == 0
    assert module.fit(no_docs, labels).weights.shape == fitted.weights.shape


def test_many_texts_of_one_id_leave_room_for_the_other_label(spark):
    docs = spark.createDataFrame([(1, f"bad text {k}", "en") for k in range(50)] + [(k, f"good text {k}", "en") for k in range(2, 12)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 0)] + [(k, 1) for k in range(2, 12)], "doc_id long, quality int")
    rows = labelled_rows(docs, labels, "quality", F.lit(True), rows=5)
    assert Counter(r["label"] for r in rows) == {0: 10, 1: 5}


def test_queries_of_the_indexed_length_are_answered(spark):
    """The length is that of the indexed vectors, whichever most queries have."""
    vectors = spark.createDataFrame([(i, [float(i), 1.0], None, None) for i in range(20)], VECTORS)
    asked = spark.createDataFrame([(100, [3.2, 1.0], None, None), (101, [1.0] * 3, None, None), (102, [2.0] * 3, None, None)], VECTORS)
    found = {(r["query_id"], r["rank"]): r["vec_id"] for r in ann.nearest(vectors, asked, k=2).collect()}
    assert found == {(100, 1): 3, (100, 2): 4}


def made_texts(seed, n, language, extra=()):
    """Texts of 40 words of a language; each word of ``extra`` goes into some of them."""
    rng = random.Random(seed)
    texts = [[f"{language}{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(40)] for _ in range(n)]
    for word, times in extra:
        for text in rng.sample(texts, times):
            text.insert(rng.randrange(len(text)), word)
    return [" ".join(t) for t in texts]


def test_rare_toxic_words_are_learned():
    # Each is in 36 of 2,100 toxic texts: words of a small language, of a long tail, and with digits and signs inside.
    tail = [(f"tail{chr(97 + k // 26)}{chr(97 + k % 26)}", 36) for k in range(300)]
    large = made_texts(1, 2000, "en", [*tail, ("id10t", 36), ("f*ol", 36)])
    small = made_texts(2, 100, "xx", [("schlimm", 36)])
    plain = made_texts(3, 2000, "en") + made_texts(4, 100, "xx")
    copies = [f"nummer {k} {large[0]} kopie" for k in range(40)]
    wanted = {w.encode() for w, _ in tail} | {b"id10t", b"f*ol", b"schlimm"}
    found = set(toxicity.distinctive(large + small + copies, plain))
    assert wanted <= found and b"kopie" not in found
    assert len(found - wanted) <= 3
    # The dictionary has room for all words found in two thirds of the texts; a few have too few texts left there.
    fitted = toxicity.fit_texts({0: plain, 1: large + small})
    assert sum(b" " + w + b" " in fitted.dictionaries[1] for w in wanted) >= 0.9 * len(wanted)
    assert len(fitted.dictionaries[1]) - len(fitted.dictionaries[0]) > 1024


def test_the_score_does_not_see_the_language_column(spark, small_docs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    fits = [toxicity.fit(docs, labels) for docs in (small_docs, small_docs.withColumn("lang", F.lit("xx")), small_docs.drop("lang"))]
    assert all(f.dictionaries == fits[0].dictionaries and (f.weights == fits[0].weights).all() for f in fits)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_scores_equal_a_plain_recomputation(module):
    """From the fitted dictionaries and weights alone, with zstandard."""
    good, bad = made_texts(5, 300, "g", [("alpha", 90)]), made_texts(6, 300, "h", [("omega", 200), ("delta", 150)])
    fitted = module.fit_texts({0: good, 1: bad} if module is toxicity else {0: bad, 1: good})
    kind = zstandard.DICT_TYPE_RAWCONTENT if fitted.plain else zstandard.DICT_TYPE_AUTO
    made = [zstandard.ZstdCompressionDict(d, dict_type=kind) for d in fitted.dictionaries]

    def size(k, data):
        options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        return len(zstandard.ZstdCompressor(level=fitted.level, dict_data=made[k], **options).compress(data))

    for text in [*good[:5], *bad[:5], "", "omega delta", good[0] + " omega " + bad[0]]:
        if module is toxicity:
            line = (" " + " ".join(text.split()) + " ").encode()
            parts = [line[at : at + 128] for at in range(0, max(1, len(line) - 16), 112)]
            plain = [size(0, p) for p in parts]
            saved = [a - size(1, p) for a, p in zip(plain, parts, strict=True)]
            top = sorted(saved)[-3:]
            found = [np.mean(saved), np.mean([s >= 3 for s in saved]), np.mean(top), max(saved), sum(plain) / sum(map(len, parts))]
        else:
            data = text.encode()
            parts = [data[at : at + 1024] for at in range(0, max(1, len(data)), 1024)]
            a, b = size(0, data), size(1, data)
            each = [(size(0, p), size(1, p)) for p in parts]
            differences = [(x - y) / max(x, y) for x, y in each]
            n = max(1, len(data))
            found = [(a - b) / max(a, b), min(2, min(a, b) / n), np.mean(differences), max(differences), min(2, sum(map(min, each)) / n)]
        raw = fitted.weights[0] + sum(w * (f - c) / s for w, f, c, s in zip(fitted.weights[1:], found, fitted.centre, fitted.spread, strict=True))
        wanted = 1 / (1 + np.exp(-np.clip(raw, -30, 30)))
        assert probability(fitted, module.features(fitted, text)) == pytest.approx(wanted, rel=1e-9)


def test_records_round_trip(spark, edge_docs, no_docs):
    path = queries.tokenizer_file("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    manifest = records.write_records(edge_docs, scratch(spark), path, rows_per_file=4)
    found = records.read_records(manifest).orderBy("file", "record").collect()
    ids = [r["doc_id"] for r in found]
    assert ids == sorted(ids, key=lambda d: (d is None, d)) and len(found) == edge_docs.count() and manifest.count() > 1
    texts = {}
    for r in edge_docs.collect():
        encoded = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
        texts.setdefault(r["doc_id"], []).append((len(encoded) // 4, zlib.crc32(encoded)))
    before = 0
    for r in found:
        assert r["before"] == before and (r["n_tokens"], r["ids_crc32"]) in texts[r["doc_id"]]
        before += r["n_tokens"]
    first = manifest.orderBy(F.desc("n_records")).first()
    assert 1 < first["n_records"] <= 4
    for number in (first["n_records"] - 1, 0):
        doc_id, tokens = records.read_at(first["path"], number)
        row = next(r for r in found if (r["file"], r["record"]) == (first["file"], number))
        assert (doc_id, len(tokens), zlib.crc32(tokens.tobytes())) == (row["doc_id"], row["n_tokens"], row["ids_crc32"])
    empty = records.write_records(no_docs, scratch(spark), path)
    assert empty.count() == 0 and records.read_records(empty).count() == 0


def test_files_keep_their_bounds_whatever_ids_repeat(spark):
    rows = [(None if k % 2 else 5, f"text {k}") for k in range(200)]
    path, docs = queries.tokenizer_file("word_bpe_49k.json"), spark.createDataFrame(rows, "doc_id long, text string")
    manifest = records.write_records(docs, scratch(spark), path, rows_per_file=7)
    sizes = [r["n_records"] for r in manifest.collect()]
    assert sum(sizes) == 200 and max(sizes) == 7
    ids = [r["doc_id"] for r in records.read_records(manifest).orderBy("file", "record").collect()]
    assert ids == [5] * 100 + [None] * 100


def test_broken_records_are_found():
    data = bytearray(records.framed(records.payload(5, np.array([1, 70_000], "<u4"))))
    doc_id, ids, end = records.read_record(bytes(data))
    assert (doc_id, ids.tolist(), end) == (5, [1, 70_000], len(data))
    assert records.read_record(records.framed(records.payload(None, np.zeros(0, "<u4"))))[0] is None
    for at in (0, 9, 15, len(data) - 1):
        broken = bytearray(data)
        broken[at] ^= 1
        with pytest.raises(ValueError, match="broken"):
            records.read_record(bytes(broken))


def test_record_query(spark):
    tokenizer, start = Tokenizer.from_file(queries.tokenizer_file("word_bpe_49k.json")), 0
    found = {r["doc_id"]: r for r in queries.QUERIES["op9_records"](spark, SMALL).collect()}
    rows = sorted((r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect())
    assert len(found) == len(rows)
    for doc_id, text in rows:
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [1]
        assert tuple(found[doc_id])[1:] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
