"""From documents to packed token sequences, in stages.

Each stage takes all that the one before kept.  Results go to the shared folder as parquet and are
read again, so a stage can be repeated without those before it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillwright.llm import bag_minhash, binary_packing, boosted_pii, host_quality
from tillwright.llm.common import prepare_workers, read_table
from tillwright.session import work_folder


#: Words that the Python workers remember, which they share with the stages before.
MEMO_WORDS = 50_000
#: Workers serve all stages, so what a task frees goes back to the system instead of staying with the worker.
WORKER_MEMORY = {
    "ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": "1048576",
}


def _prepare(spark: SparkSession) -> None:
    prepare_workers(spark)
    for name, value in WORKER_MEMORY.items():
        spark.sparkContext.environment.setdefault(name, value)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that their rules or their host's record reject."""
    _prepare(spark)
    return host_quality.keep_good(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    _prepare(spark)
    return bag_minhash.keep_one(spark, docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With personal data replaced by its kind."""
    return boosted_pii.redact(docs, boosted_pii.train(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids whose lengths are powers of two."""
    _prepare(spark)
    return binary_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), memo_words=MEMO_WORDS)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL can neither tokenize nor train; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is that of the last one."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
