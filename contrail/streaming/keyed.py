"""State per key kept in tables, so that a stream needs none of its own (ST1, ST2).

``KeyedState`` takes the batches of a stream through a *fold*: a function that reduces rows to one
row a key and may be applied again to rows it returned (latest row, sums). Each batch is folded and
written to a folder of its own. After ``every`` batches the snapshot before and the batches since
are folded into a new snapshot; a reader folds the newest snapshot with the batches after it.

So what a reader reads and what a compaction writes follow the number of keys, not the length of
the stream, and only the folders since the snapshot are listed. A batch that is run again replaces
its folder. A batch is folded into a snapshot once a later batch has begun, when it is committed
and cannot come again. ``every`` belongs to the table: it must not change between runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.versions import VersionedTable

EVERY = 16


def latest_row(keys: list[str], order: list[str], payload: list[str], sums: list[str] = ()) -> Callable[[DataFrame], DataFrame]:
    """Fold: per key the row with the largest ``order`` (nulls smallest, then by the payload) and the sums of all rows.

    An aggregate that combines before the shuffle; a key that holds a third of a batch is one row
    of each input partition.
    """
    def fold(rows: DataFrame) -> DataFrame:
        best = rows.groupBy(*keys).agg(F.max(F.struct(*order, *payload)).alias("_best"), *[F.sum(c).alias(c) for c in sums])
        return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in (*order, *payload)], *sums)

    return fold


class KeyedState:
    def __init__(self, spark: SparkSession, path: str, fold: Callable[[DataFrame], DataFrame], every: int = EVERY):
        self.spark, self.path, self.fold, self.every = spark, path, fold, every
        self.snapshots = VersionedTable(spark, f"{path}/estado")

    def covered(self) -> int:
        """Batches below this number are in the newest snapshot (0: there is none)."""
        return self.snapshots.versions().agg(F.max("version")).first()[0] or 0

    def _batches(self, first: int) -> DataFrame | None:
        # snapshots are taken at multiples of ``every``: all later batches lie in one folder
        try:
            return self.spark.read.parquet(f"{self.path}/lotes/tramo={first // self.every}").drop("batch_id")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None  # no batch since

    def stored(self) -> DataFrame | None:
        """Rows a reader has to fold: the newest snapshot and the batches after it; None before the first batch."""
        first = self.covered()
        parts = [self.spark.read.parquet(f"{self.snapshots.data}/version={first}")] if first else []
        since = self._batches(first)
        parts += [since] if since is not None else []
        if not parts:
            return None
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def read(self) -> DataFrame | None:
        """One row a key; None before the first batch."""
        rows = self.stored()
        return None if rows is None else self.fold(rows)

    def absorb(self, rows: DataFrame, batch_id: int) -> None:
        """Take in batch ``batch_id`` of a stream; batches come in order, the last one possibly again."""
        if batch_id and batch_id % self.every == 0 and self.covered() < batch_id:
            self.snapshots.commit(self.read(), batch_id)
        self.fold(rows).write.mode("overwrite").parquet(f"{self.path}/lotes/tramo={batch_id // self.every}/batch_id={batch_id}")
