"""The operators as queries over the sample tables."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import (
    bag_minhash,
    bag_ranking,
    binary_packing,
    boosted_pii,
    byte_bpe,
    exact_sharding,
    host_quality,
    link_trust,
    ngram_trie,
    nn_descent,
    page_template,
    sharded_lloyd,
    token_counts,
)
from tillwright.llm.common import prepare_workers
from tillwright.llm.common import read_table as read


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_workers(spark)
    return read(spark, sf_dir, name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op2_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_trust.judge(spark, read_table(spark, sf_dir, "pages"))


def op3_page_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_template.extract_pages(spark, read_table(spark, sf_dir, "pages"))


def op4_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(spark, read_table(spark, sf_dir, "embeddings"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode(read_table(spark, sf_dir, "documents"), ranks, pattern)
    return byte_bpe.decode(encoded, ranks, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op6_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.judge(spark, read_table(spark, sf_dir, "documents"))


def op7_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return binary_packing.crc32_of_ids(binary_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")))


def op8_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(spark, read_table(spark, sf_dir, "documents"))


def op9_exact_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_sharding.text_digests(exact_sharding.shuffle_into_shards(spark, docs))


def op10_boosted_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return boosted_pii.report(docs, boosted_pii.train(docs))


def op11_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_trie.score_corpus(spark, read_table(spark, sf_dir, "documents"))[0]


def op12_bag_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_ranking.rank(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_sharded_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_lloyd.cluster(spark, read_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_link_trust": op2_link_trust,
    "op3_page_template": op3_page_template,
    "op4_nn_descent": op4_nn_descent,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_host_quality": op6_host_quality,
    "op7_binary_packing": op7_binary_packing,
    "op8_bag_minhash": op8_bag_minhash,
    "op9_exact_sharding": op9_exact_sharding,
    "op10_boosted_pii": op10_boosted_pii,
    "op11_ngram_trie": op11_ngram_trie,
    "op12_bag_ranking": op12_bag_ranking,
    "op13_sharded_lloyd": op13_sharded_lloyd,
    "pipeline": pipeline,
}
