from collections import Counter

import corpus_pipeline
import numpy as np
from llm_data import SMALL
from pyspark.sql import functions as F
from test_dedup import plain_components, plain_cut, plain_print
from tokenizers import Tokenizer

from candlelake.llm import mixing, packing, quality, queries


def test_pipeline_equals_plain_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = corpus_pipeline.run(spark, SMALL).collect()

    fitted = quality.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = docs.select("*", quality.quality(F.col("text"), fitted).alias("s")).collect()
    good = sorted((r for r in scores if r["s"] >= 0.5), key=lambda r: r["doc_id"])
    assert 0 < len(good) < len(scores)
    components = plain_components({r["doc_id"]: (r["doc_id"], plain_print(r["text"])) for r in good})
    kept = [r for r in good if components[r["doc_id"]][1] == r["doc_id"]]
    assert len(kept) < len(good)
    cut = plain_cut([(r["doc_id"], r["text"]) for r in kept])
    texts = [(r["doc_id"], text if gone else r["text"], r["source"]) for r, (_, gone, text) in zip(kept, cut, strict=True)]
    plan = mixing.mixing_plan(spark.createDataFrame(texts, "doc_id long, text string, source string"))
    tokenizer, wanted = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json")), Counter()
    for r in plan.collect():
        n = len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1
        for at in range(0, n, 1024):
            wanted[(r["doc_id"], at, min(1024, n - at), n)] += r["__mix_copies"]
    assert Counter((r["doc_id"], r["start"], r["length"], r["doc_tokens"]) for r in found) == +wanted
    assert max(Counter({s: sum(r["length"] for r in found if r["sequence_id"] == s) for s in {r["sequence_id"] for r in found}}).values()) <= 1024


def test_stages_keep_the_columns_and_survive_edges(spark, edge_docs, no_docs):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "substring_dedup", "mixing", "packing"]
    for given in (edge_docs, no_docs):
        docs = given
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SMALL)
            assert docs.columns == given.columns
        assert (corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count() > 0) == (given is edge_docs)


def test_sequences_can_be_rebuilt_from_the_pipeline(spark):
    tokenizer = Tokenizer.from_file(queries.tokenizer_file("byte_bpe_50k.json"))
    docs = spark.createDataFrame([(1, "one two three"), (1, "one two three"), (None, None), (2, "four " * 3000)], "doc_id long, text string")
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    wanted = Counter()
    for r in docs.collect():
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        wanted.update((r["doc_id"], at // 4, ids[at : at + 4096]) for at in range(0, len(ids), 4096))
    rows = packed.collect()
    assert Counter((r["doc_id"], r["start"], whole[r["sequence_id"]][4 * r["offset"] : 4 * (r["offset"] + r["length"])]) for r in rows) == wanted
