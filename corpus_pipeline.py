"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

1. language_id: rows whose language is rejected go;
2. ngram_join: one row of each near-duplicate class stays;
3. decontaminate: rows that hold a window of the benchmark go;
4. secrets: secrets are replaced in place, every row stays;
5. mix: rows are drawn to the sources' target weights, dealt to shards and shuffled there; a row
   drawn several times appears as often. This stage adds mix_shard.

All but the last return the columns they got. Null texts and texts without letters are rejected
by the first stage; empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from commentguard.llm import decontaminate, language, mixing, ngram_join, secrets
from commentguard.llm.common import materialise, read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs, mixing.SIZE_EXPR, ["doc_id", "text"])


STAGES = [
    ("language_id", language_id),
    ("ngram_join", near_duplicates),
    ("decontaminate", decontamination),
    ("secrets", secret_scan),
    ("mix", mix_sources),
]

# The battery of the secret scan and the draw of the mix cannot be written in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
