"""Shared helpers: tables in the shared folder, bounded membership filters, components, hot keys."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.session import scratch_path

#: A membership filter never holds more bits than this (16 MiB broadcast). With more keys it
#: fills up and lets more rows through to the exact step behind it; results stay the same.
MAX_FILTER_BITS = 1 << 27
_SEGMENT_BITS = 1 << 16
#: Most bytes of an Arrow batch that goes to a Python worker (``small_batches``).
BATCH_BYTES = 4 << 20
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back; a lost executor re-reads files."""
    path = scratch_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches between JVM and Python unless the deployment sets its own number.

    Spark's default of 10,000 rows is tens of MB of text, which a task holds in the JVM outside the
    heap (buffers grow by doubling) and once more in its Python worker.
    """
    if not spark.sparkContext.getConf().contains(_BATCH_BYTES):
        spark.conf.set(_BATCH_BYTES, BATCH_BYTES)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``: the split that held-out rows are taken by."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def mix64(h: np.ndarray) -> np.ndarray:
    """Splitmix64 finaliser; uint64 in and out."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def give_back() -> None:
    """Return freed memory to the system: a Python worker serves many tasks and stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def released(run):
    """A task's function that gives freed memory back when it ends."""
    def go(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return go


# -- membership filters ---------------------------------------------------------------------


def filter_bits(n_keys: int) -> int:
    """A power of two near 16 bits a key, from 2^16 to MAX_FILTER_BITS."""
    return int(min(MAX_FILTER_BITS, max(_SEGMENT_BITS, 1 << int(16 * max(n_keys, 1) - 1).bit_length())))


def positions(keys: np.ndarray, bits: int) -> np.ndarray:
    """Two bit positions a key, as an array of shape (2, n)."""
    h = mix64(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    mask = np.uint64(bits - 1)
    return np.stack([h & mask, (h >> np.uint64(32)) & mask]).astype(np.int64)


class KeyFilter:
    """Bits of a Bloom filter; ``hit`` is true for every key put in, and for few others."""

    def __init__(self, bitmap: np.ndarray, bits: int):
        self.bitmap, self.bits = bitmap, bits

    def hit(self, keys: np.ndarray) -> np.ndarray:
        p = positions(keys, self.bits)
        set_ = (self.bitmap[p >> 3] >> (p & 7).astype(np.uint8)) & 1
        return set_.all(axis=0).astype(bool)


_BITS_SCHEMA = "segment int, part int, once binary, twice binary"


def _bitmaps(bits: int, column: str):
    """Per task: the bits that its keys set, and those that two or more of its keys set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        once = np.zeros(bits, dtype=bool)
        twice = np.zeros(bits, dtype=bool)
        for batch in batches:
            col = batch.column(column).drop_null()
            if not len(col):
                continue
            for row in positions(col.to_numpy(zero_copy_only=False), bits):
                at, n = np.unique(row, return_counts=True)
                twice[at] |= once[at] | (n > 1)
                once[at] = True
        part = TaskContext.get().partitionId() % 32
        for s in range(0, bits, _SEGMENT_BITS):
            a = once[s : s + _SEGMENT_BITS]
            if a.any():
                b = twice[s : s + _SEGMENT_BITS]
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([s // _SEGMENT_BITS], pa.int32()), "part": pa.array([part], pa.int32()),
                    "once": pa.array([np.packbits(a, bitorder="little").tobytes()], pa.binary()),
                    "twice": pa.array([np.packbits(b, bitorder="little").tobytes()], pa.binary())})

    return run


def _merge(pdf):
    once = np.zeros(_SEGMENT_BITS // 8, dtype=np.uint8)
    twice = once.copy()
    for a, b in zip(pdf["once"], pdf["twice"]):
        a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
        twice |= b | (once & a)
        once |= a
    out = pdf.iloc[:1][["segment", "part"]].copy()
    out["once"], out["twice"] = [once.tobytes()], [twice.tobytes()]
    return out


def key_filter(df: DataFrame, column: str, n_keys: int, repeated: bool = False) -> KeyFilter:
    """Bloom filter over a long column; with ``repeated``, over keys that may occur twice or more.

    Each task folds its keys into bitmaps; segments of 8 KiB are merged in two steps, so no
    task holds more than a few hundred of them, and the bounded result goes out as a broadcast.
    """
    bits = filter_bits(n_keys)
    parts = df.select(column).mapInArrow(_bitmaps(bits, column), _BITS_SCHEMA)
    merged = parts.groupBy("segment", "part").applyInPandas(_merge, _BITS_SCHEMA)
    merged = merged.groupBy("segment").applyInPandas(_merge, _BITS_SCHEMA)
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    step = _SEGMENT_BITS // 8
    for row in merged.select("segment", F.col("twice" if repeated else "once").alias("b")).toLocalIterator():
        bitmap[row.segment * step : (row.segment + 1) * step] = np.frombuffer(row.b, np.uint8)
    return KeyFilter(bitmap, bits)


def without_ids(docs: DataFrame, id_col: str, gone: DataFrame, name: str) -> DataFrame:
    """``docs`` without the rows whose long id is in ``gone`` (one column of that name); null ids stay.

    Only rows that a bounded filter of the ids may hold shuffle; all others pass straight through.
    """
    gone = keep(gone.where(F.col(id_col).isNotNull()).distinct(), name)
    shared = docs.sparkSession.sparkContext.broadcast(key_filter(gone, id_col, gone.count()))

    def part(maybe: bool):
        def run(batches):
            for batch in batches:
                col = batch.column(id_col)
                hit = np.zeros(len(col), dtype=bool)
                known = np.asarray(col.is_valid())
                if known.any():
                    hit[known] = shared.value.hit(col.drop_null().to_numpy(zero_copy_only=False))
                yield batch.filter(pa.array(hit == maybe))

        return docs.mapInArrow(run, docs.schema)

    return part(False).unionByName(part(True).join(gone, id_col, "left_anti").select(*docs.columns))


# -- hot keys -------------------------------------------------------------------------------


def hot_join(rows: DataFrame, groups: DataFrame, key: str, size: str, n_rows: int, parts: int = 500) -> DataFrame:
    """Left join of ``rows`` to one row a key of ``groups``, hot keys by broadcast.

    A key with a share of 1/parts of the rows or more is hot; there are at most ``parts`` such
    keys, which bounds the broadcast. The other keys go through a shuffled join.
    """
    limit = max(1, n_rows // parts)
    hot = groups.where(F.col(size) >= limit)
    cold = groups.where(F.col(size) < limit)
    others = [c for c in groups.columns if c != key]
    tagged = rows.join(F.broadcast(hot.select(F.col(key).alias("_hot"), F.struct(*others).alias("_g"))),
                       F.col(key) == F.col("_hot"), "left")
    warm = tagged.where(F.col("_hot").isNotNull()).select(*rows.columns, *[F.col(f"_g.{c}").alias(c) for c in others])
    rest = tagged.where(F.col("_hot").isNull()).select(*rows.columns).join(cold, key, "left")
    return warm.unionByName(rest.select(*warm.columns))


# -- connected components -------------------------------------------------------------------


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable, for each id that occurs in ``edges`` (a, b).

    Alternating large-star and small-star rounds over the edge list (each a grouped minimum and
    a join back), written to the shared folder after each; stops when a round changes nothing.
    """
    e = keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .where("u <> v").distinct(), f"{name}-edges")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")),
                                                               F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").where("u <> v").distinct())
        e = keep(small, f"{name}-stars")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == now:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component")).unionByName(
        e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
