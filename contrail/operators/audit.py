"""Change audit from snapshots (re-aimed from row triggers, S06/S09/S11).

``snapshot_diff`` compares two versions of a keyed table with a full
outer join on the key (one shuffle, both sides partitioned by key) and
labels INSERT / UPDATE / DELETE; UPDATE needs a null-safe difference
in a watched column (``IS DISTINCT FROM``). ``signed_history`` adds a
stable JSON snapshot and its SHA-256; ``verify`` recomputes the hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, watch: list[str]) -> DataFrame:
    o = old.select(key, *[F.col(c).alias(f"old_{c}") for c in watch], F.lit(True).alias("_in_old"))
    n = new.select(key, *[F.col(c).alias(f"new_{c}") for c in watch], F.lit(True).alias("_in_new"))
    j = o.join(n, key, "full_outer")
    changed = F.lit(False)
    for c in watch:
        changed = changed | ~F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}"))
    op = (F.when(F.col("_in_old").isNull(), "INSERT").when(F.col("_in_new").isNull(), "DELETE")
           .when(changed, "UPDATE"))
    return j.withColumn("operacion", op).where(F.col("operacion").isNotNull()).drop("_in_old", "_in_new")


def snapshot_json(cols: list[Column]) -> Column:
    """to_jsonb(row) with a fixed field order and explicit nulls."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def signed_history(changes: DataFrame, snapshot: Column) -> DataFrame:
    return changes.withColumn("snapshot_completo", snapshot) \
                  .withColumn("hash_integridad", F.sha2(F.col("snapshot_completo"), 256))


def verify(history: DataFrame) -> DataFrame:
    """Rows whose stored hash no longer matches their snapshot (tamper check)."""
    return history.where(F.sha2(F.col("snapshot_completo"), 256) != F.col("hash_integridad"))
