import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SMALL
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candlelake.llm import mixing, packing, queries, sharding
from candlelake.llm.tokens import Encoder


WORD = re.compile("[^\x20\x09-\x0d]+")


def shares(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    fixed, wanted = set(), share * sum(sizes.values())
    while len(fixed) < len(names):
        left = wanted - sum(most * sizes[s] for s in fixed)
        level = left / sum(weight[s] for s in names if s not in fixed)
        above = {s for s in names if s not in fixed and weight[s] * level >= most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in fixed else weight[s] * level for s in names}
        fixed |= above
    return {s: most * sizes[s] for s in names}


def test_mixing_targets_and_copies(edge_docs):
    rows = mixing.mixing_plan(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    sizes = Counter()
    for r in rows:
        assert r["__mix_size"] == len(WORD.findall(r["text"] or ""))
        sizes[r["source"]] += r["__mix_size"]
    targets = shares(sizes)
    for r in rows:
        assert r["__mix_source_size"] == sizes[r["source"]]
        assert r["__mix_target"] == pytest.approx(targets[r["source"]])
        rate = r["__mix_target"] / r["__mix_source_size"] if r["__mix_source_size"] else 0
        assert math.floor(rate) <= r["__mix_copies"] <= math.ceil(rate) <= 2


def test_mixing_repeats_rows(edge_docs, no_docs, small_docs):
    plan = mixing.mixing_plan(edge_docs)
    mixed = mixing.mix(edge_docs)
    assert mixed.columns == edge_docs.columns
    assert mixed.count() == plan.agg(F.sum("__mix_copies")).first()[0]
    assert mixing.mix(no_docs).count() == 0
    taken = mixing.mixing_plan(small_docs).agg(F.sum(F.col("__mix_size") * F.col("__mix_copies")), 1.5 * F.sum("__mix_size")).first()
    assert taken[0] == pytest.approx(taken[1], rel=0.15)


def test_mixing_matches_its_sql(spark):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    wanted = sorted(connection.execute(queries.ORACLES["op1_mixing"]).fetchall())
    found = sorted(tuple(r) for r in queries.QUERIES["op1_mixing"](spark, SMALL).collect())
    assert found == wanted


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 64, 1000])
def test_permutation_is_one(spark, rows):
    found = [r[0] for r in spark.range(rows).select(sharding.walked(F.col("id"), rows, 5)).collect()]
    assert sorted(found) == list(range(rows))
    if rows == 1000:
        assert found != sorted(found)


def test_shards(edge_docs, no_docs):
    keys = edge_docs.select("doc_id", "text", "shard", "size")
    order = [F.col(c).asc_nulls_last() for c in ("doc_id", "text")]
    rows = sharding.shard_rows(keys, order, shards=3).collect()
    assert sorted(r["row_number"] for r in rows) == list(range(edge_docs.count()))
    sizes = Counter(r["shard"] for r in rows)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    ids = [r["doc_id"] for r in sorted(rows, key=lambda r: r["row_number"])]
    assert ids == sorted(ids, key=lambda d: (d is None, d))
    assert sorted(map(str, sharding.shard_rows(keys, order, shards=3).collect())) == sorted(map(str, rows))
    assert sharding.shard_rows(no_docs.select("doc_id", "text"), order).count() == 0


def test_shard_query_and_files(spark, tmp_path):
    found = queries.QUERIES["op2_sharding"](spark, SMALL)
    table = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in found.collect():
        data = (table[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 1, zlib.crc32(data), "rows", None)
    sharding.write_shards(found.drop("grown_shard"), str(tmp_path / "shards"))
    read = spark.read.parquet(str(tmp_path / "shards"))
    assert read.groupBy("shard").count().count() == 8 and read.count() == len(table)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), max_size=32))
def test_patterns_hold_all_lengths(histogram):
    patterns = packing.shortest_pack_first(histogram, 32)
    held = Counter()
    for pattern, count in patterns:
        assert sum(pattern) <= 32 and count > 0
        for size in pattern:
            held[size] += count
    assert held == Counter(histogram)


def test_packing(spark, edge_docs, no_docs):
    path = queries.tokenizer_file("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    packed = packing.pack_documents(edge_docs, path, 64).collect()
    wanted = Counter()
    for row in edge_docs.collect():
        ids = tokenizer.encode(row["text"] or "", add_special_tokens=False).ids + [0]
        for at in range(0, len(ids), 64):
            piece = np.array(ids[at : at + 64], "<u4").tobytes()
            wanted[(row["doc_id"], at, len(piece) // 4, zlib.crc32(piece), len(ids))] += 1
    assert Counter(tuple(r)[:5] for r in packed) == wanted
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r["offset"])
        ends = np.cumsum([r["length"] for r in rows])
        assert [r["offset"] for r in rows] == [0, *ends[:-1]] and ends[-1] <= 64
    frame = packing.pack_documents(edge_docs.where("doc_id < 7"), path, 64)
    whole = {r["sequence_id"]: r for r in packing.sequences(frame).collect()}
    for r in frame.collect():
        ids = whole[r["sequence_id"]]["ids"]
        assert ids[4 * r["offset"] : 4 * (r["offset"] + r["length"])] == r["ids"]
    assert packing.pack_documents(no_docs, path).count() == 0
    with pytest.raises(ValueError, match="lengths"):
        packing.pack_pieces(spark.createDataFrame([(1, 0, 9)], "doc_id long, start long, length long"), 8).count()


def test_packed_ids_lie_in_their_sequences(spark, small_docs, monkeypatch):
    tokenizer = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    wanted = {r["doc_id"]: np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4").tobytes() for r in small_docs.collect()}
    # Rows as they come: the pieces of a sequence follow each other, and rebuild it and the documents.
    found, parts, done = {}, {}, None
    for r in packing.pack_documents(small_docs, queries.tokenizer_file("byte_bpe_50k.json")).collect():
        assert done == r["sequence_id"] or r["sequence_id"] not in found
        done = r["sequence_id"]
        found[done] = found.get(done, b"")
        assert len(found[done]) == 4 * r["offset"]
        found[done] += r["ids"]
        parts.setdefault(r["doc_id"], {})[r["start"]] = r["ids"]
    assert {k: b"".join(v[at] for at in sorted(v)) for k, v in parts.items()} == wanted
    assert max(map(len, found.values())) <= 4096
    # The query's checksums are those of the ids that come out of the packing.
    whole = packing.pack_documents
    monkeypatch.setattr(packing, "pack_documents", lambda *a, **k: whole(*a, **k).withColumn("ids", F.lit(b"other")))
    assert {r["ids_crc32"] for r in queries.op3_packing(spark, SMALL).collect()} == {zlib.crc32(b"other")}


def test_wide_ids_travel_whole():
    import zstandard

    for numbers in ([], [0, 65_535], [65_536, 7, 2**32 - 1]):
        ids = np.array(numbers, "<u4").tobytes()
        assert packing.widened(packing.squeezed(ids, zstandard.ZstdCompressor().compress), zstandard.ZstdDecompressor().decompress) == ids


def test_little_padding(spark):
    lengths = packing.pack_documents(spark.read.parquet(f"{SMALL}/documents.parquet"), queries.tokenizer_file("byte_bpe_50k.json"), with_ids=False)
    used, sequences = lengths.agg(F.sum("length"), F.countDistinct("sequence_id")).first()
    assert used > 0.95 * 1024 * (sequences - 1)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(spark, name):
    path = queries.tokenizer_file(name)
    tokenizer, own = Tokenizer.from_file(path), Encoder(path)
    hard = [
        "", " ", "  a", "a  b", "a   b", "a\n b", "a\n  b ", "a \n", "don't it's 'tis WE'LL", "<|endoftext|> x <|startoftext|>",
        "x<|endoftext|>", "é é ö Σας İx", "a\x1cb \x85c\xa0d　e", "under_score $$$###, 12a3 4.5%", "日本語 テキスト",
        "\t\ttabs\r\nend\n\n", "ﬁ ½ Ⅷ ªº", "ab​cd", "A.B,C", "AbC def. GHI!!", " \n\n x",
    ]
    rng = np.random.default_rng(1)
    hard += ["".join(rng.choice(list("ab' \n\t.,$1é́<|>_SA"), 30)) for _ in range(500)]
    texts = [r["text"] or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    for text in hard + texts + hard:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_columns_of_the_input_pass_whatever_their_names(spark):
    docs = spark.createDataFrame([(k, f"words of text {k}", "a", f"note {k}") for k in range(30)], "doc_id long, text string, source string, mix_note string")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {r["mix_note"] for r in mixed.collect()} <= {f"note {k}" for k in range(30)}


def plain_walk(number, rows, seed):
    """The permutation in whole numbers: six rounds over a domain of two factors, again until the number is a row's."""
    a = max(1, math.isqrt(max(rows - 1, 0)) + 1)
    b = max(1, -(-rows // a))
    factor, mask = 2_654_435_761, (1 << 31) - 1
    keys = [((seed + 1) * 1_000_003 + k * 7_368_787) * factor % mask for k in range(6)]

    def mixed(half, key, size):
        x = ((half ^ key) * factor) & ((1 << 62) - 1)
        return ((((x ^ (x >> 29)) & mask) * factor) >> 17) % size

    while True:
        high, low = divmod(number, b)
        for turn, key in enumerate(keys):
            if turn % 2:
                low = (low + mixed(high, key, b)) % b
            else:
                high = (high + mixed(low, key, a)) % a
        number = high * b + low
        if number < rows:
            return number


@pytest.mark.parametrize("rows", [1, 2, 37, 1000, 70_001])
def test_places_equal_a_plain_walk(spark, rows):
    asked = spark.range(0, rows, max(1, rows // 300))
    found = asked.select("id", sharding.walked(F.col("id"), rows, 42).alias("place")).collect()
    assert all(r["place"] == plain_walk(r["id"], rows, 42) for r in found)


def test_shard_query_equals_plain_places_and_survives_edges(spark, edge_docs, no_docs, tmp_path):
    for name, docs in (("small", spark.read.parquet(f"{SMALL}/documents.parquet")), ("edges", edge_docs), ("none", no_docs)):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        found = queries.QUERIES["op2_sharding"](spark, f"{tmp_path}/{name}").collect()
        texts = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()]
        wanted = Counter((d, len(t) + 1, zlib.crc32(t)) for d, t in texts)
        assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == wanted
        places = sorted((r["shard"], r["slot"]) for r in found)
        assert places == sorted((p % 8, p // 8) for p in range(len(texts)))
        # In order of id (nulls last), size and checksum, a row's place is that of its number.
        order = sorted(found, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]))
        own = [Counter(), Counter()]
        for number, r in enumerate(order):
            place = plain_walk(number, len(texts), 42)
            key = (r["doc_id"], r["size"], r["text_crc32"])
            own[0][key, r["shard"], r["slot"]] += 1
            own[1][key, place % 8, place // 8] += 1
        assert own[0] == own[1]
