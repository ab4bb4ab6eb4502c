"""From documents to packed training sequences: five stages, each written as Parquet and read again by the next.

``run`` has no SQL answer, since compression, tokenizing and packing are outside SQL; tests hold it against a plain
computation on a small table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlelake.llm import mixing, packing, quality, simhash, substring
from candlelake.llm.common import stored
from candlelake.llm.queries import tokenizer_file

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

LEAST_QUALITY = 0.5
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score by a classifier fitted on the labelled ones is 0.5 or more."""
    fitted = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(quality.quality(F.col("text"), fitted) >= LEAST_QUALITY)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.drop_near_duplicates(docs)


def remove_repeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; ``n_chars`` follows the text."""
    cut = substring.remove_repeated(docs).select(*docs.columns)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources have their target weights."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 token ids: pieces with their ``ids``, sequence by sequence in order of their offsets."""
    return packing.pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", remove_repeated),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents; the last one's rows are the result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
