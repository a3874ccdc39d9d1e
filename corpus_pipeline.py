"""Corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a table that is written as
Parquet and read again as the next one's documents.  All but the last return
the columns of ``documents``:

1. quality      - documents that the classifier rejects go
2. near copies  - one document of each group of linked documents stays
3. benchmark    - documents that hold a benchmark passage go
4. personal     - personal data in the texts is masked
5. tokens       - texts become token ids, and are decoded again as a check
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import bpe, decontaminate, ngram_join, pii, quality
from ledgerlake.llm.common import packed, read_table, small_batches, table_bytes
from ledgerlake.llm.queries import RANKS
from ledgerlake.session import checkpoint_dir, ship_package


def prepare(spark: SparkSession) -> None:
    """What stages with Python workers need: the package, and small batches."""
    ship_package(spark)
    small_batches(spark)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality.accepted(packed(docs), read_table(spark, sf_dir, "labels"))


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.one_of_each(packed(docs))


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(decontaminate.clean_documents(docs, read_table(spark, sf_dir, "benchmark")), table_bytes(docs))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pii.masked_documents(packed(docs))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``ids``, ``n_tokens`` and ``round_trip`` (the decoded ids
    are the text again)."""
    prepare(spark)
    return bpe.checked(packed(docs), bpe.ranks_bytes(RANKS))


STAGES = [
    ("quality", quality_stage),
    ("near_copies", near_copy_stage),
    ("benchmark", benchmark_stage),
    ("personal_data", personal_data_stage),
    ("tokens", token_stage),
]

#: a trained network is no SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; their tables lie in the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    root = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{k}-{name}")
        docs = spark.read.parquet(f"{root}/{k}-{name}")
    return docs
