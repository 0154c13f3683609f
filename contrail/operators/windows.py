"""Ordered window operators that survive hot keys.

``lead_by_key`` computes LEAD(value) OVER (PARTITION BY key ORDER BY o)
without putting a whole key into one task:

1. range-partition the rows on (key, order) -- a hot key is split across
   several range partitions -- and tag each row with its partition id;
   the tagged frame is checkpointed so every later use sees the same ids;
2. LEAD inside each (partition id, key) group, whose size is bounded by
   the range partition size;
3. the last row of a group takes the first value of the same key in the
   next non-empty partition: one row per (partition id, key), ordered by
   partition id -- at most one row per partition for any key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.session import checkpoint_dir, write_table


def lead_by_key(df: DataFrame, key: str, order: list[str], value: str, out: str,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = next row's ``value`` for the same ``key`` in ``order``.

    ``order`` must be a total order within a key (append a unique column).
    Nulls in order columns sort first, as in an ascending Spark window.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    cols = [key, *order]
    tagged = (df.repartitionByRange(n, *[F.col(c).asc_nulls_first() for c in cols])
                .withColumn("_pid", F.spark_partition_id()))
    # written out so every later use sees the same partition ids
    tagged = write_table(tagged, "lead_by_key")
    w = Window.partitionBy("_pid", key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    local = tagged.withColumn(out, F.lead(value).over(w))
    ordk = F.struct(*[F.col(c) for c in order])
    heads = tagged.groupBy("_pid", key).agg(F.min_by(F.col(value), ordk).alias("_first"))
    wk = Window.partitionBy(key).orderBy("_pid")
    nxt = heads.withColumn("_next_first", F.lead("_first").over(wk)).select("_pid", key, "_next_first")
    # same window spec as the LEAD, so no second sort
    local = local.withColumn("_is_last", F.lead(F.lit(1)).over(w).isNull())
    j = local.join(nxt, ["_pid", key], "left")
    return j.withColumn(out, F.when(F.col("_is_last"), F.col("_next_first")).otherwise(F.col(out))) \
            .drop("_pid", "_next_first", "_is_last")
