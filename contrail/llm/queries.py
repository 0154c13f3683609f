"""Registered queries of the thirteen operators, with production parameters over whole tables."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import op1_elias_fano, op11_license, op12_repair, op13_prefix_trie, op2_mix, op3_pii, op10_cover_tree, op4_bloom, op5_templates, op7_skip_join, op8_toxicity as toxicity, op9_bpe
from contrail.llm import op6_quality as quality
from contrail.llm.common import documents


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = op1_elias_fano.held_out(F.col("doc_id"))
    return op1_elias_fano.score(documents(spark, sf_dir), held).withColumn("held_out", held)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = op2_mix.mix(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"))
    return mixed.select("doc_id", F.col("_source").alias("source"), F.col("_lang").alias("lang"), F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"),
                        F.col("_weight").alias("weight"), F.col("_prob").alias("prob"), F.col("_kept").alias("kept"))


def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return op3_pii.digest(op3_pii.find(docs, op3_pii.train(docs)))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_bloom.exact_dedup(documents(spark, sf_dir))


def op5_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_templates.drop_recurring_lines(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = quality.held_out(F.col("doc_id"))
    return _decided(quality.score(docs, quality.train(docs, labels, "quality", ~held)), held)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7_skip_join.classes(documents(spark, sf_dir))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_cover_tree.near_dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = toxicity.held_out(F.col("doc_id"))
    return _decided(toxicity.score(docs.select("doc_id", "text"), toxicity.train(docs, labels, ~held)), held)


def _decided(scored: DataFrame, held) -> DataFrame:
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@lru_cache(maxsize=2)
def vocabulary(path: str | None = None) -> op9_bpe.Vocabulary:
    import public_tokenizers

    return op9_bpe.Vocabulary.read(path or public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocab = vocabulary()
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return op9_bpe.encode(docs, vocab, public_tokenizers.PATTERN, decoded="decoded").select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_license.digest(op11_license.hits(documents(spark, sf_dir)))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12_repair.repair(op12_repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


def op13_prefix_trie_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_prefix_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {f.__name__: f for f in (op1_lm_score, op2_mix_sources, op3_pii_spans, op4_exact_dedup, op5_line_templates, op6_quality, op7_jaccard_join, op8_toxicity, op9_byte_bpe, op10_embedding_dedup, op11_license_scan, op12_conversation_repair, op13_prefix_trie_nodes)}
ORACLE = {"op4_exact_dedup": op4_bloom.SQL}
