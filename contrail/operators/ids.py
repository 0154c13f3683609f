"""Dense surrogate keys and keyed picks without a single-partition window.

``ROW_NUMBER() OVER (ORDER BY k)`` with no PARTITION BY forces every row
through one task. ``dense_index`` instead range-partitions on the order
key, numbers rows inside each partition, and adds per-partition offsets
computed from a tiny (one row per partition) aggregate. The numbered
frame is checkpointed to the shared checkpoint folder first so both
uses see identical partitions even if an executor is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contrail.functions.det import u
from contrail.session import checkpoint_dir, write_table


def dense_index(df: DataFrame, order: list, name: str = "idx", start: int = 1,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``order`` (a total order)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    ordered = (df.repartitionByRange(n, *order)
                 .sortWithinPartitions(*order)
                 .withColumn("_pid", F.spark_partition_id())
                 .withColumn("_mid", F.monotonically_increasing_id()))
    ordered = write_table(ordered, "dense_index")
    counts = ordered.groupBy("_pid").agg(F.count("*").alias("_n"), F.min("_mid").alias("_m0"))
    # one row per partition: bounded by the partition count, safe to broadcast
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    out = ordered.join(F.broadcast(offs.select("_pid", "_m0", "_off")), "_pid")
    return out.withColumn(name, F.col("_off") + (F.col("_mid") - F.col("_m0")) + F.lit(start)) \
              .drop("_pid", "_mid", "_m0", "_off")


def keyed_pick_join(df: DataFrame, key: Column, salt: str, candidates: DataFrame,
                    cand_order: list, cand_cols: list[str], prefix: str = "pick_") -> DataFrame:
    """Attach one candidate row per input row, chosen by u(key, salt).

    Replaces ``(SELECT ... ORDER BY random() LIMIT 1)``: candidates get a
    dense index 0..n-1, each row computes ``floor(u * n)`` and equi-joins.
    """
    idx = dense_index(candidates.select(*cand_cols), cand_order, "_ci", start=0)
    n = idx.count()  # one scalar; the indexed candidates are already written out
    tagged = df.withColumn("_ci", F.floor(u(key, salt) * F.lit(n)).cast("long"))
    picked = idx.select("_ci", *[F.col(c).alias(prefix + c) for c in cand_cols])
    return tagged.join(picked, "_ci", "left").drop("_ci")
