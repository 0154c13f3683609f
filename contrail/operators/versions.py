"""Tables kept as numbered versions in the shared folder, with a chained history and a key registry on top.

``VersionedTable`` writes a version's rows to a folder of its own and then one manifest row (row
count and a sum of row hashes). A version exists once its manifest row does, so a write that was
cut short is simply written again and a repeated commit of the same version adds nothing.

* ``append_history`` -- signed, append-only change history (N2): every row carries the SHA-256 of
  its snapshot and a chain hash over the chain hash of the key's row before it.
* ``check_history``  -- reads the stored rows and names those that were altered, whose chain is
  broken (a row before them went or changed), and versions whose rows no longer add up (N3).
* ``extend_registry`` -- surrogate keys that survive a reload (E3, T9): only natural keys that no
  version has yet are numbered, on from the largest number given so far.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from contrail.operators.ids import dense_index

_MANIFEST = "version int, filas long, huella decimal(38,0)"
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _footprint(rows: DataFrame) -> list:
    """Row count and a sum of row hashes: both follow any change of a value, row or copy."""
    columns = sorted(c for c in rows.columns if c != "version")
    return [F.count("*").alias("filas"), F.coalesce(F.sum(F.xxhash64(*columns).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).cast("decimal(38,0)").alias("huella")]


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.data, self.manifest = spark, f"{path}/data", f"{path}/manifest"

    def versions(self) -> DataFrame:
        """The manifest: version, filas, huella."""
        try:
            return self.spark.read.parquet(self.manifest).select("version", "filas", "huella")
        except AnalysisException as e:
            if not any(x in (e.getCondition() or "") for x in _ABSENT):
                raise
            return self.spark.createDataFrame([], _MANIFEST)

    def numbers(self) -> list[int]:
        return sorted(r.version for r in self.versions().select("version").distinct().collect())  # one row a version

    def read(self) -> DataFrame | None:
        """Rows of all versions with their ``version``; None before the first."""
        there = self.numbers()
        if not there:
            return None
        return self.spark.read.parquet(self.data).where(F.col("version").isin(there))

    def commit(self, rows: DataFrame, version: int) -> bool:
        """Store ``rows`` as ``version``; False (and nothing written) if that version exists."""
        if version in self.numbers():
            return False
        folder = f"{self.data}/version={version}"
        rows.write.mode("overwrite").parquet(folder)
        stored = self.spark.read.schema(rows.schema).parquet(folder)
        stored.agg(*_footprint(stored)).select(F.lit(version).cast("int").alias("version"), "filas", "huella").write.mode("append").parquet(self.manifest)
        return True


def _chain(previous: str = "hash_previo"):
    return F.sha2(F.concat_ws("|", previous, "operacion", "hash_integridad"), 256)


def append_history(table: VersionedTable, changes: DataFrame, key: str, version: int) -> bool:
    """Add ``changes`` (key, operacion, snapshot_completo, one row a key) as a version of the signed history.

    The chain of a key goes on from its last stored row; a key without one starts from an empty
    hash. Only the changed keys are looked up, in the key, version and chain columns.
    """
    signed = changes.select(key, "operacion", "snapshot_completo").withColumn("hash_integridad", F.sha2("snapshot_completo", 256))
    before = table.read()
    if before is None:
        linked = signed.withColumn("hash_previo", F.lit(""))
    else:
        last = before.where(F.col("version") < version).groupBy(key).agg(F.max_by("hash_cadena", "version").alias("hash_previo"))
        linked = signed.join(last, key, "left").withColumn("hash_previo", F.coalesce("hash_previo", F.lit("")))
    return table.commit(linked.withColumn("hash_cadena", _chain()), version)


def check_history(table: VersionedTable, key: str) -> DataFrame:
    """Faults of the stored history: key, version and falla.

    HASH: the snapshot no longer has its hash. CADENA: the chain hash does not follow from the row,
    or the row before is not the one it was chained to. MANIFIESTO (no key): the version's rows are
    not those that were committed.
    """
    rows = table.read()
    empty = f"{key} long, version int, falla string"
    if rows is None:
        return table.spark.createDataFrame([], empty)
    order = Window.partitionBy(key).orderBy("version")
    linked = rows.withColumn("_before", F.coalesce(F.lag("hash_cadena").over(order), F.lit("")))
    wrong = F.array_compact(F.array(F.when(F.sha2("snapshot_completo", 256) != F.col("hash_integridad"), "HASH"),
                                    F.when((_chain() != F.col("hash_cadena")) | (F.col("_before") != F.col("hash_previo")), "CADENA")))
    by_row = linked.select(key, "version", F.explode(wrong).alias("falla"))
    now = rows.groupBy("version").agg(*_footprint(rows)).select("version", F.col("filas").alias("n"), F.col("huella").alias("h"))
    off = table.versions().join(now, "version", "left").where(~(F.col("filas").eqNullSafe(F.coalesce("n", F.lit(0))) & F.col("huella").eqNullSafe(F.coalesce("h", F.lit(0).cast("decimal(38,0)")))))
    return by_row.unionByName(off.select(F.lit(None).cast(rows.schema[key].dataType).alias(key), "version", F.lit("MANIFIESTO").alias("falla")))


def extend_registry(table: VersionedTable, keys: DataFrame, columns: list[str], name: str, version: int) -> DataFrame:
    """All registered keys (columns, name) after numbering those of ``keys`` that are new, in their order.

    Numbers start at 1 and are never given twice; a key keeps its number whatever is added later.
    Keys with a null part are not registered. Repeating a version adds nothing.
    """
    fresh = keys.select(*columns).dropna().distinct()
    known = table.read()
    start = 1
    if known is not None:
        fresh = fresh.join(known.select(*columns), columns, "left_anti")
        start = (known.agg(F.max(name)).first()[0] or 0) + 1
    table.commit(dense_index(fresh, columns, name, start=start).select(*columns, F.col(name).cast("long").alias(name)), version)
    return table.read().select(*columns, name)
