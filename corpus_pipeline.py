"""The corpus pipeline: language, near duplicates, repeated passages, benchmark contamination, token ids.

Each stage takes and returns documents; the next one reads what it wrote. The last adds token_ids and n_tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from evigraph.llm import bpe_codec, decontaminate, jaccard_join, language_id, queries, suffix_dedup
from evigraph.llm.storage import written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any letter have no language and go; of the others a missing language is filled in."""
    return language_id.identified(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return jaccard_join.representatives(docs)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of strings that occur more than once are taken out of the texts; all documents stay."""
    return suffix_dedup.without_repeats(docs)


def contamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts through their ids and back; adds token_ids and n_tokens."""
    return bpe_codec.round_tripped(docs, queries.vocabulary("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("language ID", language_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("suffix-array dedup", passage_stage),
    ("benchmark decontamination", contamination_stage),
    ("byte-level BPE encoding and decoding", token_stage),
]

#: SQL can't express parsing against automata, or merges by rank; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = written(docs, f"stage-{number}")
    return docs
