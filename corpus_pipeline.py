"""Corpus pipeline: language ID, near-dedup, decontamination, mixing, token output.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame
that is written as Parquet and read again as the next stage's docs. All but the last return the
columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bluelines.llm import decontaminate, langid, mixing, near_dedup, token_index
from bluelines.llm.common import table
from bluelines.session import work_path


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or with no language ahead of the others, go."""
    return langid.keep_known(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near duplicates stays."""
    return near_dedup.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item occurs go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times)."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids written to shards with their index, and read back: doc_id, start, n_tokens, ids_crc32."""
    folder = work_path(spark, "tokens")
    buckets = token_index.write(docs, folder, tokenizer_file())
    return token_index.read(spark, folder, docs.select("doc_id"), buckets)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("token_output", token_ids),
]

#: Compression, random rounding and tokenizing are not SQL; tests/llm compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
