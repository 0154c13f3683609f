"""Exact dedup: two-pass Bloom filtering finds possibly repeated hashes; only those rows shuffle.

Pass 1 folds a 64-bit hash of each text into per-task bitmaps "seen" and "seen twice", merged
to one bounded filter. Pass 2 tests every row against it: rows that cannot be repeated pass
straight through as groups of one; the others (true repeats and a few false hits) shuffle as
(id, SHA-256) and are grouped exactly. A fuller filter lets more rows shuffle, never fewer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import hot_join, keep, key_filter


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty, so null and empty texts form one group. The largest id of a
    group stays; rows that share that id all stay (ties), a null id stays only where the group
    has no other (and is never kept beside an id). An empty table gives no rows; other columns
    are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    hashed = docs.select(F.col(id_col).alias("doc_id"), F.sha2(text.cast("binary"), 256).alias("text_sha256"),
                         F.xxhash64(text).alias("h"))
    n = docs.count()
    repeated = spark.sparkContext.broadcast(key_filter(hashed, "h", n, repeated=True))

    def test(batches):
        for batch in batches:
            hit = repeated.value.hit(batch.column("h").to_numpy(zero_copy_only=False)) if len(batch) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_sha256"), pa.array(hit)],
                                             names=["doc_id", "text_sha256", "maybe"])

    tested = hashed.mapInArrow(test, f"doc_id {hashed.schema['doc_id'].dataType.simpleString()}, text_sha256 string, maybe boolean")
    single = tested.where("not maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                                              F.lit(True).alias("kept"), "text_sha256")
    maybe = keep(tested.where("maybe").select("doc_id", "text_sha256"), "repeated")
    groups = maybe.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    grouped = hot_join(maybe, groups, "text_sha256", "group_size", n).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    return single.unionByName(grouped)


SQL = """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
