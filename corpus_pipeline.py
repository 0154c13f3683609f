"""Pipeline from raw documents to encoded training data: five stages, each a llm operator.

A stage takes what its predecessor kept, as written to Parquet and read again. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import op2_mix, op5_templates, op7_skip_join, op8_toxicity, op9_bpe
from contrail.llm.common import documents, keep, small_batches, without_ids
from contrail.llm.queries import vocabulary

TOXIC = 0.7
#: Word shingles of near duplicates; op7's own contract (4 words, 85 %) binds only the query.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below TOXIC stay; learned from the labels that op8 may learn from."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = op8_toxicity.train(docs, labels, ~op8_toxicity.held_out(F.col("doc_id")))
    scored = op8_toxicity.score(docs, model, out="_toxicity")
    return scored.where(F.col("_toxicity") < TOXIC).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go but for their first document; every document stays."""
    small_batches(spark)
    got = op5_templates.drop_recurring_lines(docs)
    return got.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts the document with the smallest id stays."""
    small_batches(spark)
    found = op7_skip_join.classes(docs, words=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id")
    return without_ids(docs, "doc_id", gone, "near-duplicates")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by the calibrated probabilities of their source, language and topic."""
    return op2_mix.mix(docs).where("_kept").select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian 32-bit) of each document, with the hash of what they decode to."""
    import public_tokenizers

    small_batches(spark)
    # a smaller memo: the executors hold what the stages before left in memory
    return op9_bpe.encode(docs, vocabulary(), public_tokenizers.PATTERN, decoded="decoded", memo_bytes=12 << 20).select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
          ("mixing sources to target weights", mixing), ("byte-level BPE encoding and decoding", byte_bpe)]

#: The trained stage and the tokenizer cannot be expressed in SQL; tests/llm/test_pipeline.py has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
