"""Spark session helpers.

Cluster settings (checkpoint folder, shuffle partitions, executor sizing)
belong to whoever launches the job. The helpers here only fill in values
that are unset, which is what tests and the local bench need.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on for deterministic, oracle-comparable output.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # keyed dedup aggregates structs (sort-based); generate code for it
    "spark.sql.codegen.aggregate.sortAggregate.enabled": "true",
    # the JVM never compiles larger methods (long expressions such as the geodesic solver);
    # Spark then generates code by operator instead, which is several times faster
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: Bytes of files that a task reads unless the deployment sets its own number: grouping rows by key sorts
#: all rows of a task in memory, which it holds without spilling only if a task has some million rows.
_SIZES = {"spark.sql.files.maxPartitionBytes": "16m"}
#: Row groups of written tables (before compression), so that a scan can be split that finely.
ROW_GROUP_BYTES = 32 << 20


def get_spark(master: str | None = None, app: str = "contrail",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.driver.memory", os.environ.get("CONTRAIL_DRIVER_MEM", "16g"))
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in _REQUIRED.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    configure(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Pin session settings that results depend on (time zone, AQE); bound what a task reads."""
    for k, v in _REQUIRED.items():
        spark.conf.set(k, v)
    given = spark.sparkContext.getConf()
    for k, v in _SIZES.items():
        if not given.contains(k):
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialized marts.

    Reads ``spark.checkpoint.dir`` from the session; only when it is unset
    (tests, local bench) a fresh scratch folder is created and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="contrail-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """Path under the shared checkpoint folder for a named output."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def write_table(df, name: str):
    """Cut lineage by writing ``df`` as Parquet under the shared folder and reading it back.

    Columnar and durable: later plans prune columns, push filters, and a
    lost executor re-reads files instead of recomputing the lineage.
    """
    import uuid

    from contrail.sources.tables import spread
    spark = df.sparkSession
    path = scratch_path(spark, f"tables/{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return spread(spark.read.parquet(path))
