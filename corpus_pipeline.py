"""The corpus pipeline: documents in, encoded clean documents out.

``STAGES`` are functions of (spark, docs, sf_dir).  Each works on all rows that its
predecessor kept; ``run`` writes every stage's result as Parquet to the shared
checkpoint folder and reads it again as the next one's documents, so a lost executor
never costs more than the stage at work.

1. quality    documents that the quality rules reject go
2. duplicates one document of each near-duplicate group stays: the one with the smallest id
              (of equal ids, the first in the order of the other columns)
3. benchmark  documents with a passage of the benchmark go
4. secrets    every secret becomes ``[secret]``; ``n_chars`` is counted anew
5. encode     token ids, their count and digests, the decoded text's digest

Documents with a null id are kept or rejected by their own text: a null id takes part in
the quality rules unlabelled, and of several null ids in a group one stays.  Repeated
rows of one id and text are one document from stage 2 on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlift.llm import bpe, decontaminate, ngram_join, quality, secret_scan
from ledgerlift.llm.common import scratch_path, table
from ledgerlift.llm.queries import tokenizer_json


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.kept_documents(docs, table(spark, sf_dir, "labels"))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.one_per_group(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.with_digests(bpe.round_trip(docs, tokenizer_json()))


STAGES = [("quality", quality_stage), ("duplicates", duplicates_stage), ("benchmark", benchmark_stage),
          ("secrets", secrets_stage), ("encode", encode_stage)]

# Hashed n-gram weights, character models and BPE ids are beyond SQL; tests/llm compares
# the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
