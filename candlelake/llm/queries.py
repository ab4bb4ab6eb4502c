"""The registered queries of this subpackage, each with the SQL that answers it where SQL can express it.

Each query is thin: it applies its operator to the whole table and derives the columns that are compared.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.llm import (
    ann,
    fingerprint,
    mixing,
    packing,
    periodic,
    quality,
    records,
    rules,
    sharding,
    simhash,
    substring,
    toxicity,
    whitening,
)
from candlelake.llm.common import scratch

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TOKENIZERS = os.environ.get("TOKENIZER_FILES", "/opt/tokenizers")


def tokenizer_file(name: str) -> str:
    """A vocabulary file: in the installed package of public tokenizers, or in the folder ``TOKENIZER_FILES``."""
    try:
        import public_tokenizers
    except ModuleNotFoundError:
        return f"{TOKENIZERS}/{name}"
    return public_tokenizers.path(name)


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query(
    "op1_mixing",
    r"""
    WITH sized AS (
        SELECT doc_id, source, text, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size,
               [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER] AS weight
        FROM sized GROUP BY source
    ), ranked AS (
        -- Sources in the order in which a rising level reaches their caps.
        SELECT *, 2 * source_size AS cap, 1.5 * sum(source_size) OVER () AS wanted,
               coalesce(sum(2 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
               sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST
                   ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
        FROM sources
    ), levels AS (
        SELECT max((wanted - capped)::DOUBLE / free::DOUBLE)
               FILTER (WHERE cap::DOUBLE > weight * ((wanted - capped)::DOUBLE / free::DOUBLE)) AS level
        FROM ranked
    ), targets AS (
        SELECT source, source_size,
               CASE WHEN level IS NULL THEN cap::DOUBLE ELSE least(cap::DOUBLE, weight * level) END AS target
        FROM ranked, levels
    ), rated AS (
        SELECT doc_id, size, source_size, target,
               CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
               ('0x' || md5(concat_ws(':', '42', doc_id::VARCHAR, md5(text)))[1:13])::BIGINT / 4503599627370496.0 AS drawn
        FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
    )
    SELECT doc_id, size, source_size, target,
           (size * (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
    FROM rated
    """,
)
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixing_plan(documents(spark, sf_dir))
    return plan.select(
        "doc_id",
        F.col("__mix_size").alias("size"),
        F.col("__mix_source_size").alias("source_size"),
        F.col("__mix_target").alias("target"),
        (F.col("__mix_size") * F.col("__mix_copies")).alias("taken"),
    )


@query("op2_sharding")
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keys = documents(spark, sf_dir).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64("text").alias("tie")
    )
    order = [F.col("doc_id").asc_nulls_last(), F.col("size"), F.col("text_crc32"), F.col("tie")]
    return sharding.shard_rows(keys, order).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op3_packing")
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"))
    # Of the ids as they lie in their sequences, not of those that went into the packing.
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op4_simhash")
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", digits, "component_id")


@query("op8_substring")
def op8_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeated(documents(spark, sf_dir).select("doc_id", "text"))
    words = F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", " ")
    kept = F.trim(words).cast("binary")
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(kept, 256).alias("kept_sha256"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def remainder(doc_id: Column, by: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % by


def classified(docs: DataFrame, score: Column, held_out: Column) -> DataFrame:
    found = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), score.alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), remainder(F.col("doc_id"), 5) == 0
    fitted = toxicity.fit(docs, labels(spark, sf_dir), ~held_out)
    return classified(docs, toxicity.toxicity(F.col("text"), fitted), held_out)


@query("op9_records")
def op9_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = records.write_records(documents(spark, sf_dir), scratch(spark), tokenizer_file("word_bpe_49k.json"))
    read = records.read_records(manifest)
    return read.select("doc_id", F.col("before").alias("start"), "n_tokens", "ids_crc32")


@query("op10_quality")
def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = documents(spark, sf_dir), remainder(F.col("doc_id"), 3) == 1
    fitted = quality.fit(docs, labels(spark, sf_dir), ~held_out)
    return classified(docs, quality.quality(F.col("text"), fitted), held_out)


@query("op5_fingerprint")
def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(documents(spark, sf_dir))


@query("op6_ann")
def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


@query(
    "op11_rules",
    r"""
    WITH texts AS (
        SELECT row_number() OVER () AS row_id, doc_id, source, coalesce(text, '') AS text FROM documents
    ), split AS MATERIALIZED (
        SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
               list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
        FROM texts
    ), places AS (
        SELECT row_id, unnest(range(1, len(words) - 3)) AS place,
               unnest(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS stretch
        FROM split
    ), twice AS (
        SELECT row_id, list(place) AS places FROM places GROUP BY row_id, stretch HAVING count(*) > 1
    ), starts AS (
        SELECT row_id, unnest(places) AS place FROM twice
    ), repeated AS (
        SELECT row_id, count(DISTINCT place + step) AS n_repeat_words
        FROM starts, (SELECT unnest(range(0, 5)) AS step) GROUP BY row_id
    ), measured AS (
        SELECT doc_id, source, len(words)::BIGINT AS n_words,
               length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
               (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
               (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
               coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
        FROM split LEFT JOIN repeated USING (row_id)
    ), judged AS MATERIALIZED (
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
    ), hosts AS (
        SELECT source, count(*)::BIGINT AS host_docs, count_if(base_failed)::BIGINT AS host_failures
        FROM judged WHERE source IS NOT NULL GROUP BY source
    ), sums AS (
        SELECT count(*)::DOUBLE AS h, sum(host_docs)::DOUBLE AS n, sum(host_failures)::DOUBLE AS k,
               sum(host_docs::DOUBLE * host_docs) AS nn, sum(host_failures::DOUBLE * host_failures / host_docs) AS kk
        FROM hosts
    ), moments AS (
        SELECT k / n AS mean, ((kk - k * k / n) / nullif(k / n * (1 - k / n), 0) - (h - 1)) / nullif(n - nn / n - (h - 1), 0) AS between_hosts
        FROM sums
    ), rates AS (
        SELECT source, host_docs, host_failures,
               CASE WHEN between_hosts > 0 THEN (host_failures + mean * strength) / (host_docs + strength) ELSE mean END AS rate
        FROM hosts, (SELECT *, greatest(2.0, 1 / least(1.0, between_hosts) - 1) AS strength FROM moments)
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND coalesce(rate <= 0.5, true) AS kept, host_docs, host_failures
    FROM judged LEFT JOIN rates USING (source)
    """,
)
def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(documents(spark, sf_dir))
    return judged.select("doc_id", *rules.MEASURES, "base_failed", "kept", "host_docs", "host_failures")


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def tail_repeated(text: Column, doc_id: Column) -> Column:
    """The text of the contract: of every tenth id, by its crc32, the end is replaced by repeats of its first words."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("([^\\x20\\x09-\\x0D]+)"), F.lit(1))
    h = F.crc32(doc_id.cast("string").cast("binary"))
    n, g = F.size(words), F.floor(h / 10)
    # Without words there is nothing to divide by.
    a = g % F.nullif(n, F.lit(0))
    p = 1 + F.floor((n - a) / (3 + g % 8))
    start, length = a.cast("int"), p.cast("int")
    times = F.ceil((n - a) / p).cast("int")
    repeats = F.flatten(F.array_repeat(F.slice(words, start + 1, length), times))
    repeated = F.slice(F.concat(F.slice(words, F.lit(1), start), repeats), F.lit(1), n)
    return F.when((h % 10 == 0) & (n > 0), F.array_join(repeated, " ")).otherwise(text)


@query("op13_runs")
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = docs.select("doc_id", periodic.periodic(tail_repeated(F.col("text"), F.col("doc_id"))).alias("__p"))
    rows = found.select("doc_id", "__p.*")

    def greater(best: Column, run: Column) -> Column:
        longer = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | longer, run).otherwise(best)

    # Runs are in order, so the first of equal exponents stays.
    best = F.aggregate("runs", F.get("runs", F.lit(0)), greater)
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.array_join(F.transform(line, lambda x: F.concat(x, F.lit("\n"))), "")
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[name].alias(name) for name in ("start", "length", "period")],
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
