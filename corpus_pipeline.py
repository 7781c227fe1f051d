"""The corpus pipeline: language ID, near-duplicates, decontamination, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet into the shared
folder and reads it again for the next one.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm.common import send_package
from ledgerflow.llm.decontaminate import without_benchmark
from ledgerflow.llm.langid import keep_identified
from ledgerflow.llm.mixing import mixed_documents
from ledgerflow.llm.simhash import simhash_dedup
from ledgerflow.llm.token_ids import token_ids, word_vocabulary
from ledgerflow.session import scratch_path


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; texts without letters and ambiguous ones go."""
    send_package(spark)
    return keep_identified(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the smallest id."""
    send_package(spark)
    return simhash_dedup(docs, shingle=3, radius=2)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    send_package(spark)
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: documents with the words that the mix takes, as often as it does."""
    send_package(spark)
    return mixed_documents(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in document order, read back: doc_id, start, n_tokens, ids_crc32."""
    send_package(spark)
    return token_ids(docs, word_vocabulary())


STAGES = [("language_id", identified), ("simhash_near_dedup", deduplicated), ("benchmark_decontamination", decontaminated),
          ("source_mixing", mixed), ("token_ids", tokenised)]

#: No stage's rows can be had from SQL (learned model, XXH64 fingerprints, tiling, seeded draws, tokenizer).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
