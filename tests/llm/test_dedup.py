import hashlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from llm_data import SMALL, words
from pyspark.sql import functions as F

from candlelake.llm import queries, simhash, substring
from candlelake.llm.components import connected_components


def plain_print(text):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[k : k + 3]) for k in range(max(1, len(parts) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """Smallest reachable id by key; prints: key -> (id or None, fingerprint)."""
    parent = {k: k for k in prints}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = list(prints)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 3:
                parent[root(b)] = root(a)
    least = {}
    for k in keys:
        if prints[k][0] is not None:
            least[root(k)] = min(least.get(root(k), prints[k][0]), prints[k][0])
    return {k: (root(k), least.get(root(k))) for k in keys}


def test_simhash_query_equals_all_pairs(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    prints = {d: (d, plain_print(t)) for d, t in docs.items()}
    components = plain_components(prints)
    found = queries.QUERIES["op4_simhash"](spark, SMALL).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in found} == {
        d: (f"{prints[d][1]:016x}", components[d][1]) for d in docs
    }


def test_simhash_edges(edge_docs, no_docs):
    rows = edge_docs.collect()
    prints = {k: (r["doc_id"], plain_print(r["text"])) for k, r in enumerate(rows)}
    components = plain_components(prints)
    found = Counter((r["doc_id"], r["print"] % 2**64, r["component_id"]) for r in simhash.near_duplicates(edge_docs).collect())
    assert found == Counter((d, p, components[k][1]) for k, (d, p) in prints.items())
    kept = simhash.drop_near_duplicates(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == len({c[0] for c in components.values()})
    assert simhash.near_duplicates(no_docs).count() == 0 and simhash.drop_near_duplicates(no_docs).count() == 0


def test_links_connect_every_close_pair(spark):
    """A dense ball of fingerprints, pairs at every distance, and blocks smaller than the ball."""
    rng = np.random.default_rng(3)
    centre = int(rng.integers(0, 2**63))
    prints = {centre ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 3)), replace=False)) for _ in range(300)}
    for _ in range(60):
        base = int(rng.integers(0, 2**63))
        far = int(rng.integers(1, 6))
        prints |= {base, base ^ sum(1 << int(b) for b in rng.choice(63, far, replace=False))}
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    wanted = plain_components({p: (p, p % 2**64) for p in signed})
    before = simhash.BLOCK
    try:
        for block in (before, 16):
            simhash.BLOCK = block
            links = simhash.near_links(frame).collect()
            assert all(((r["a"] ^ r["b"]) % 2**64).bit_count() <= 3 for r in links)
            found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
            for p in signed:
                assert found.get(p, p) == wanted[p][1]
    finally:
        simhash.BLOCK = before


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 600)] + [(7, 7), (-5, 3), (3, -5)]
    edges += [tuple(map(int, e)) for e in rng.integers(1000, 1100, (60, 2))]
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert found == {k: root(k) for k in parent}


def plain_cut(rows):
    """rows of (id or None, text): per row (words, removed, kept)."""
    order = [(float("inf") if d is None else d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in order:
        for k in range(len(w) - 12):
            key = tuple(w[k : k + 13])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in order:
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - 12):
            if first[tuple(w[k : k + 13])] < d:
                gone[k : k + 13] = True
        out.append((len(w), int(gone.sum()), b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()))
    return out


def test_substring_query_equals_plain(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    wanted = {(d, n, g, hashlib.sha256(k.encode()).hexdigest()) for (d, _), (n, g, k) in zip(docs, plain_cut(docs), strict=True)}
    assert {tuple(r) for r in queries.QUERIES["op8_substring"](spark, SMALL).collect()} == wanted


def test_substring_edges_in_many_chunks(spark, edge_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    # One passage in every document, repeats inside one document, and a window that ends where a text ends.
    rows += [(100 + k, f"{words(13)} own{k} {words(13, 500)}") for k in range(40)] + [(50, words(13, 900) + " " + words(13, 900))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("given")).withColumn("key", F.lit(1))
    names = ("CHUNK_BYTES", "BYTES_PER_RANGE", "SEGMENTS", "MOST_CELL_BITS", "LIST_WINDOWS", "MOST_PARTITIONS")
    before = tuple(getattr(substring, name) for name in names)
    try:
        # The last one has chunks that grow by the number of segments and share three partitions.
        for sizes in (before, (20_000, 5_000, 4, 16, 0, 99), (50_000, 50_000, 1, 13, 0, 99), (1_000, 5_000, 4, 13, 8, 3)):
            for name, size in zip(names, sizes, strict=True):
                setattr(substring, name, size)
            found = substring.remove_repeated(frame).collect()
            got = Counter((r["doc_id"], r["n_words"], r["n_removed"], " ".join((r["text"] or "").encode().decode().split(" "))) for r in found if r["n_removed"])
            wanted = Counter((d, n, g, k) for (d, _), (n, g, k) in zip(rows, plain_cut(rows), strict=True) if g)
            assert got == wanted
            kept = Counter((r["doc_id"], r["text"]) for r in found if not r["n_removed"])
            assert kept == Counter(row for row, (_, g, _) in zip(rows, plain_cut(rows), strict=True) if not g)
    finally:
        for name, size in zip(names, before, strict=True):
            setattr(substring, name, size)
    assert substring.remove_repeated(no_docs).count() == 0


def test_parts_of_substring_removal_stay_bounded_as_the_text_grows():
    for text_bytes in (0, 1, 10**6, 10**9, 10**11, 10**12, 10**14):
        size = substring.Size.of(text_bytes)
        assert size.segments << size.bits >= substring.CELLS_PER_BYTE * text_bytes
        assert size.bits <= substring.MOST_CELL_BITS and size.partitions <= substring.MOST_PARTITIONS
        chunk_bytes = text_bytes / size.chunks
        assert chunk_bytes <= substring.MOST_CHUNK_BYTES
        if text_bytes >= 10**9:
            # Windows in the list that a chunk sends to a segment.
            assert chunk_bytes / substring.WINDOW_BYTES / size.segments > (15 if text_bytes == 10**14 else 63)


def test_the_survivor_of_equal_texts_is_the_same_in_every_run(spark):
    rows = [(1, "the same text of some words", f"s{k}", {"k": k}) for k in range(20)] + [(None, "other words stand here now", "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra map<string,int>")
    kept = [sorted(map(str, simhash.drop_near_duplicates(docs.repartition(n)).collect())) for n in (1, 3, 7)]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 2
