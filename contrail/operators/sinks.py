"""Sinks: append, insert-ignore, month-partitioned overwrite, materialized views.

All writes go under the shared checkpoint/warehouse folder named by the
session (``spark.checkpoint.dir``), never a machine-local path, and every
sink is idempotent under a rerun or a retried task:

* ``append``            -- plain append (A9); the caller owns idempotence.
* ``insert_ignore``     -- ON CONFLICT DO NOTHING (A10): keep new keys only
                           (left anti join against the table on the key).
* ``write_partitioned`` -- RANGE partitions by month (A14) as
                           ``partitionBy("yyyymm")`` with dynamic partition
                           overwrite: a rerun replaces only the months it
                           carries, so facts never double (T12).
* ``refresh_mv``        -- CREATE/REFRESH MATERIALIZED VIEW (A15): compute,
                           overwrite, read back.
* ``truncate_reload``   -- TRUNCATE ... RESTART IDENTITY then INSERT (A11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.dedup import first_per_key


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def insert_ignore(spark: SparkSession, new: DataFrame, path: str, key: list[str]) -> None:
    """Append rows whose key is absent from the table; duplicates within ``new`` keep one row."""
    incoming = first_per_key(new, key, [F.lit(0)])
    if _exists(spark, path):
        incoming = incoming.join(spark.read.parquet(path).select(*key), key, "left_anti")
    incoming.write.mode("append").parquet(path)


def month_key(col: str = "tiempo_id"):
    """YYYYMM partition value from a YYYYMMDD date key (integer arithmetic)."""
    return (F.col(col) / 100).cast("int")


def write_partitioned(df: DataFrame, path: str, part_col: str = "yyyymm") -> None:
    # rebalanced by month: a large month is split over several writers, small ones stay whole
    (df.hint("rebalance", part_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .option("compression", "zstd").partitionBy(part_col).parquet(path))


def read_months(spark: SparkSession, path: str, first: int, last: int, part_col: str = "yyyymm") -> DataFrame:
    """Month-range read; the filter on the partition column prunes directories."""
    return spark.read.parquet(path).where(F.col(part_col).between(first, last))


def refresh_mv(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def truncate_reload(df: DataFrame, path: str) -> DataFrame:
    """TRUNCATE ... RESTART IDENTITY + INSERT (A11): overwrite the whole table, read it back.

    Rerunning it replaces the content instead of appending to it.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
