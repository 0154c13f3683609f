"""Driver-table access.

Tables are read lazily from Parquet; Catalyst prunes columns and pushes
filters into the scan, so callers just select what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events", "documents", "embeddings", "pages",
                 "benchmark", "labels", "conversations")


SMALL_TABLES = ("region", "nation")


def spread(df: DataFrame) -> DataFrame:
    """Give an under-split input at least one partition per core.

    A table stored as one file with one row group scans as a single task,
    so every derivation on it would run single-threaded. When the scan
    has fewer partitions than the default parallelism it is redistributed
    round-robin (deterministic under retries: rows are sorted before the
    exchange). Inputs already split finer -- any large table on a
    cluster -- are returned untouched, so this never adds a shuffle at scale.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df if name in SMALL_TABLES else spread(df)
