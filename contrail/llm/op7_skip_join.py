"""N-gram Jaccard join by set-relation skipping.

Texts become sets of word shingles. Sets that are equal are one from the start. Two kinds of
skipping keep the join of the others from looking at most pairs:

- Answers derived from a similar set: a set is compared with the first of all sets that agree with
  it on one of a few pairs of minimum hashes. If it passes it is linked to it, takes over its class, and
  is never probed against the class's other members: their links say nothing new about classes.
- Index skipping: shingles are put in one order for all, frequent ones last (a bounded sketch of
  counts over all texts gives the order; any order gives the same result). Two similar sets share
  a shingle among their first few. Lists of the shingles are cut into blocks of like set size and
  kept in order of position; a probe skips blocks whose sizes cannot match, and the rest of a
  block from the first position too deep to leave enough shingles behind it. A list whose sets are
  all of one class is skipped whole.

Pairs that are left exchange parity bit maps, whose distance is never above that of the sets and
rules out nearly all dissimilar ones; the rest is compared exactly, on the texts. Links found this way join the classes; a last
pass takes connected components. No step needs a group of copies in one place: equal sets meet
in grouped minima, comparisons with a popular set are salted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import words as W
from contrail.llm.common import KeyFilter, components, hot_join, keep, key_filter, mix64

WORDS, PERCENT = 4, 85
MIN_HASHES = 8
SKETCH_BITS = 20
#: Shingles that the sketch counts below this are rare; their order does not matter.
RARE = 64
SHARD_BYTES = 48 << 20
BLOCK = 64
SALT = 256
#: Bytes of text that a task reads at a time: its arrays of words and shingles take many times that.
BLOCK_BYTES = 2 << 20
_NO_ID = (1 << 63) - 1
_K = np.uint64(0x9E3779B97F4A7C15)
_SEGMENT = 1 << 14
_SIGNED = ["id", "n", "set_key", "low", "parity", "segment", "part", "counts"]
_SIGNED_SCHEMA = "id long, n long, set_key binary, low array<long>, parity binary, segment int, part int, counts binary"


def _seed(i: int) -> np.uint64:
    return np.uint64(i * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


def parities(row: np.ndarray, h: np.ndarray, n: np.ndarray) -> list[bytes]:
    """For each row a bit map of at least 2 n bits: whether an odd number of its shingles falls on the bit.

    Two maps differ in no more bits than the sets in shingles; a map of half the size is the
    exclusive or of its halves.
    """
    size = np.int64(1) << np.ceil(np.log2(np.maximum(2 * n, 64))).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])
    at = begin[row] + (mix64(h + _seed(99)) & (size[row] - 1).astype(np.uint64)).astype(np.int64)
    bits = np.packbits((np.bincount(at, minlength=int(begin[-1])) & 1).astype(bool), bitorder="little")
    return [bits[a // 8 : z // 8].tobytes() for a, z in zip(begin[:-1].tolist(), begin[1:].tolist())]


def differing(a: bytes, b: bytes) -> int:
    """Bits in which two parity maps differ, at the size of the smaller."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(column: pa.Array, n: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, shingle) pairs, by row."""
    row, h = W.shingles(W.split(column), n, words)
    _, first = np.unique(mix64(h + row.astype(np.uint64) * _K), return_index=True)
    use = np.zeros(len(h), dtype=bool)
    use[first] = True
    return row[use], h[use]


def _needed(n: np.ndarray, percent: int) -> np.ndarray:
    """Fewest shingles that a set of ``n`` shares with any set similar to it."""
    return -(-n * percent // 100)


def _signatures(words: int, hashes: int):
    """Per document: size, a 192-bit key of the set (null if empty), pairs of minimum hashes; per task: the sketch's counts.

    Rows of the sketch have a segment, rows of documents have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        size = 1 << SKETCH_BITS
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for block in W.blocks(batch, size=BLOCK_BYTES):
                k = len(block)
                row, h = _sets(block.column("text"), k, words)
                counts += np.bincount((h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=size)
                n = np.bincount(row, minlength=k)
                first = np.concatenate([[0], np.cumsum(n)[:-1]])
                full = n > 0
                sums = [np.zeros(k, np.uint64) for _ in range(2)]
                low = np.zeros((2 * hashes, k), np.uint64)
                if full.any():
                    at = first[full]
                    for i in range(2):
                        sums[i][full] = np.add.reduceat(mix64(h + _seed(i + 1)), at)
                    for i in range(2 * hashes):
                        low[i, full] = np.minimum.reduceat(mix64(h ^ _seed(i + 11)), at)
                key = np.column_stack([n.astype(np.uint64), *sums]) if k else np.zeros((0, 3), np.uint64)
                pairs = np.stack([mix64(low[2 * i] * np.uint64(3) + low[2 * i + 1] + np.uint64(i)) for i in range(hashes)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [block.column("id"), pa.array(n.astype(np.int64)), pa.array([x.tobytes() if f else None for x, f in zip(key, full)], pa.binary()),
                     pa.array([x if f else [] for x, f in zip(pairs.T.tolist(), full)], pa.list_(pa.int64())),
                     pa.array(parities(row, h, n), pa.binary()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names=_SIGNED)
        part = TaskContext.get().partitionId() % 32
        if counts.any():
            rows = [pa.compress(counts[a : a + _SEGMENT].astype(np.uint32).tobytes(), codec="zstd", asbytes=True) for a in range(0, size, _SEGMENT)]
            k = len(rows)
            yield pa.RecordBatch.from_arrays([pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.binary()),
                                              pa.array(range(k), pa.int32()), pa.array([part] * k, pa.int32()), pa.array(rows, pa.binary())], names=_SIGNED)

    return run


# -- order of the shingles ------------------------------------------------------------------



def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(pa.decompress(x, _SEGMENT * 4, codec="zstd", asbytes=True), np.uint32).astype(np.int64) for x in pdf["counts"])
    out = pdf.iloc[:1].copy()
    out["counts"] = [pa.compress(np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes(), codec="zstd", asbytes=True)]
    return out


def shingle_ranks(parts: DataFrame) -> np.ndarray:
    """For each sketch cell, 0 for rare shingles or else the bit length of the count beyond the noise."""
    schema = "segment int, part int, counts binary"
    merged = (parts.select("segment", "part", "counts").groupBy("segment", "part").applyInPandas(_added, schema)
              .groupBy("segment").applyInPandas(_added, schema))
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for r in merged.toLocalIterator():  # 2^SKETCH_BITS counters in all
        counts[r.segment * _SEGMENT : (r.segment + 1) * _SEGMENT] = np.frombuffer(pa.decompress(r.counts, _SEGMENT * 4, codec="zstd", asbytes=True), np.uint32)
    usual = float(np.median(counts))
    above = np.maximum(counts - usual - 4 * np.sqrt(usual), 0)
    return np.where(above >= RARE, np.ceil(np.log2(above + 1)), 0).astype(np.uint8)


# -- index ----------------------------------------------------------------------------------


def _pack(a: np.ndarray) -> bytes:
    return np.int64(a.nbytes).tobytes() + pa.compress(a.tobytes(), codec="zstd", asbytes=True)


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(b[8:], int(np.frombuffer(b[:8], np.int64)[0]), codec="zstd", asbytes=True), kind)


def _prefixes(words: int, percent: int, shards: int, ranks, wanted):
    """First shingles of each wanted set in the common order, by shard of the shingle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                batch = batch.filter(pa.array(wanted.value.hit(batch.column("id").to_numpy(zero_copy_only=False))))
            for block in W.blocks(batch, size=BLOCK_BYTES):
                k = len(block)
                row, h = _sets(block.column("text"), k, words)
                n = np.bincount(row, minlength=k)
                rank = ranks.value[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.argsort((rank.astype(np.uint64) << np.uint64(56)) | (mix64(h) >> np.uint64(8)))
                order = order[np.argsort(row[order].astype(np.uint16) if k < 65536 else row[order], kind="stable")]
                row, h = row[order], h[order]
                place = np.arange(len(row)) - np.concatenate([[0], np.cumsum(n)[:-1]])[row] if len(row) else row
                use = place <= (n - _needed(n, percent))[row]
                row, h, place = row[use], h[use], place[use]
                shard = (mix64(h + np.uint64(5)) % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                ids = block.column("id").to_numpy(zero_copy_only=False)
                cut = np.flatnonzero(np.diff(shard[order], prepend=-1))
                parts = np.split(order, cut[1:]) if len(order) else []
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[order][cut], pa.int32()), *[pa.array([_pack(x[p]) for p in parts], pa.binary()) for x in
                                                               (h, ids[row], n[row].astype(np.int32), place.astype(np.int32))]], names=["shard", "h", "id", "n", "place"])

    return run


def _shared(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entries of shingles that occur in two documents or more."""
    h, i, n, p = (np.concatenate([_unpack(b, kind) for b in pdf[c]]) for c, kind in (("h", np.uint64), ("id", np.int64), ("n", np.int32), ("place", np.int32)))
    order = np.lexsort((i, h))
    h, i, n, p = h[order], i[order], n[order], p[order]
    first = np.flatnonzero(np.diff(h, prepend=~h[:1]).astype(bool)) if len(h) else np.zeros(0, np.int64)
    low = i[first]
    high = i[np.append(first[1:], len(h)) - 1] if len(h) else low
    use = np.repeat(low != high, np.diff(np.append(first, len(h))))
    return pd.DataFrame({"h": h[use].view(np.int64), "id": i[use], "n": n[use], "place": p[use]})


def candidates(h, ids, n, place, cls, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets of different classes that share a shingle of ``h`` and may be similar.

    Lists are cut into blocks of at most BLOCK sets of like size, in order of position within.
    """
    order = np.lexsort((n, h))
    h, ids, n, place, cls = (x[order] for x in (h, ids, n.astype(np.int64), place.astype(np.int64), cls))
    ends = np.append(np.flatnonzero(np.diff(h)) + 1, len(h))
    out_a, out_b = [], []
    lo = 0
    for hi in ends.tolist():
        c = cls[lo:hi]
        if hi - lo > 1 and (c != c[0]).any():  # else one class: nothing new
            blocks = []
            for a in range(lo, hi, BLOCK):
                z = min(a + BLOCK, hi)
                by = a + np.argsort(place[a:z], kind="stable")
                blocks.append((n[a], n[z - 1], by, place[by]))
            for a in range(lo, hi, BLOCK):
                probe = np.arange(a, min(a + BLOCK, hi))
                smallest, largest = n[probe[0]], n[probe[-1]]
                for b_low, b_high, by, deep in blocks[(a - lo) // BLOCK :]:
                    if b_low * percent > largest * 100:
                        break  # too large for every probe, as is all that follows
                    if b_high * 100 < smallest * percent:
                        continue
                    # the shingles after the position must be enough even for the smallest pair
                    most = b_high - -(-percent * (smallest + b_low) // (100 + percent))
                    by = by[: int(np.searchsorted(deep, most, side="right"))]
                    x, y = np.repeat(probe, len(by)), np.tile(by, len(probe))
                    nx, ny = n[x], n[y]
                    need = -(-percent * (nx + ny) // (100 + percent))
                    ok = (cls[x] != cls[y]) & (np.minimum(nx, ny) * 100 >= np.maximum(nx, ny) * percent)
                    ok &= np.minimum(nx - place[x], ny - place[y]) >= need
                    ok &= x < y if (by >= a).any() and a <= by.min() < a + BLOCK else ok
                    out_a.append(ids[x[ok]])
                    out_b.append(ids[y[ok]])
        lo = hi
    a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (out_a, out_b))
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
    return both[0], both[1]


# -- comparison -----------------------------------------------------------------------------


def _with(pairs: DataFrame, values: DataFrame, side: str) -> DataFrame:
    """``pairs`` with the values (id, others) of one side as others_side; a document in many pairs is sent to several places."""
    others = [c for c in values.columns if c != "id"]
    many = keep(pairs.groupBy(side).agg(F.count("*").alias("times")), "pair-counts")
    total = many.agg(F.sum("times")).first()[0] or 0
    spread = hot_join(pairs, many, side, "times", total)
    copies = F.ceil(F.col("times") / SALT).cast("int")
    spread = spread.withColumn("salt", F.pmod(F.xxhash64("a", "b"), copies).cast("int")).drop("times")
    sent = values.join(many.withColumnRenamed(side, "id"), "id").select(
        F.col("id").alias(side), F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt"), *[F.col(c).alias(f"{c}_{side}") for c in others])
    return spread.join(sent, [side, "salt"]).drop("salt")


def _close(percent: int):
    """Pairs whose parity maps do not rule out that the sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = (batch.column("n_a").to_numpy() + batch.column("n_b").to_numpy()) * (100 - percent)
            far = np.array([differing(x.as_py(), y.as_py()) for x, y in zip(batch.column("parity_a"), batch.column("parity_b"))], np.int64)
            ok = pa.array(far * (100 + percent) <= both)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(ok) for c in ("a", "b")], names=["a", "b"])

    return run


def _similar(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for wide in W.blocks(batch, "text_a", 4 << 20):
                for block in W.blocks(wide, "text_b", 4 << 20):
                    k = len(block)
                    (ra, ha), (rb, hb) = (_sets(block.column(c), k, words) for c in ("text_a", "text_b"))
                    _, at, _ = np.intersect1d(mix64(ha + ra.astype(np.uint64) * _K), mix64(hb + rb.astype(np.uint64) * _K), assume_unique=True, return_indices=True)
                    both = np.bincount(ra[at], minlength=k)
                    union = np.bincount(ra, minlength=k) + np.bincount(rb, minlength=k) - both
                    ok = (100 * both >= percent * union) & (both > 0)
                    yield pa.RecordBatch.from_arrays([block.column(c).filter(pa.array(ok)) for c in ("a", "b")], names=["a", "b"])

    return run


def similar_pairs(pairs: DataFrame, rows: DataFrame, maps: DataFrame, words: int, percent: int, name: str) -> DataFrame:
    """Those pairs (a, b) of distinct ids whose sets are similar.

    Parity maps (id, n, parity) rule out nearly all others; only the rest's texts shuffle.
    """
    pairs = keep(pairs, f"{name}-pairs")
    pairs = keep(_with(_with(pairs, maps, "a"), maps, "b").mapInArrow(_close(percent), "a long, b long").distinct(), f"{name}-close")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    ids = keep(ids, f"{name}-ids")
    near = key_filter(ids, "id", ids.count())
    texts = _held(rows, near).join(ids, "id", "left_semi").dropDuplicates(["id", "set_hash"]).select("id", "text")
    both = _with(_with(pairs, texts, "a"), texts, "b")
    return keep(both.mapInArrow(_similar(words, percent), "a long, b long").distinct(), f"{name}-links")


def _held(rows: DataFrame, wanted: KeyFilter) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        for batch in batches:
            if len(batch):
                yield batch.filter(pa.array(shared.value.hit(batch.column("id").to_numpy(zero_copy_only=False))))

    return rows.mapInArrow(run, rows.schema)


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of each row: the smallest id reachable over similar sets.

    Null and empty texts and texts without words have no shingles and are linked with nothing;
    a text of fewer than ``words`` words has one, the whole sequence. Rows that share an id are one
    node (each row keeps its own n_shingles); rows with a null id are one node that comes after
    all others, and whose component is null if nothing else is in it. Other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("id"), text.alias("text"), F.xxhash64(text).alias("set_hash"))
    both = keep(rows.select("id", "text").mapInArrow(_signatures(words, MIN_HASHES), _SIGNED_SCHEMA), "signatures")
    signed = both.where("segment is null").select("id", "n", "set_key", "low", "parity")
    maps = both.where("set_key is not null").select("id", "n", "parity")
    total = signed.count()

    # equal sets
    groups = signed.where("set_key is not null").groupBy("set_key").agg(F.min("id").alias("rep"), F.count("*").alias("size"))
    groups = keep(groups, "equal-sets")
    equal = hot_join(signed.where("set_key is not null").select("id", "set_key"), groups.where("size > 1"), "set_key", "size", total)
    equal = equal.where("rep is not null").select(F.col("rep").alias("a"), F.col("id").alias("b")).where("a <> b").distinct()
    reps = keep(hot_join(signed.where("set_key is not null").drop("parity"), groups, "set_key", "size", total).where("id = rep")
                .dropDuplicates(["set_key"]).select("id", "n", "low"), "sets")

    # sets that take over the class of a similar one
    low = reps.select("id", F.posexplode("low").alias("k", "v")).select("id", F.xxhash64("k", "v").alias("v"))
    firsts = low.groupBy("v").agg(F.min("id").alias("a"), F.count("*").alias("size")).where("size > 1")
    stars = hot_join(low, firsts, "v", "size", total * MIN_HASHES).groupBy(F.col("id").alias("b")).agg(F.min("a").alias("a")).where("a < b").select("a", "b")
    links = similar_pairs(stars, rows, maps, words, percent, "stars")
    edges = keep(equal.unionByName(links), "class-links")
    known = components(edges, "classes")

    # the index over what may still be linked
    wanted = spark.sparkContext.broadcast(key_filter(reps, "id", total))
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("b")).first().b or 0
    shards = max(1, -(-size // SHARD_BYTES))
    ranks = spark.sparkContext.broadcast(shingle_ranks(both.where("segment is not null")))
    entries = (rows.select("id", "text").mapInArrow(_prefixes(words, percent, shards, ranks, wanted), "shard int, h binary, id binary, n binary, place binary")
               .groupBy("shard").applyInPandas(_shared, "h long, id long, n int, place int"))
    entries = keep(entries, "index")
    n_entries = entries.count()
    buckets = max(1, -(-n_entries // 400_000))
    classed = entries.join(known, "id", "left").select("h", "id", "n", "place", F.coalesce("component", "id").alias("cls"), F.pmod(F.xxhash64("h"), F.lit(buckets)).alias("bucket"))

    def probe(pdf: pd.DataFrame) -> pd.DataFrame:
        a, b = candidates(*(pdf[c].to_numpy() for c in ("h", "id", "n", "place", "cls")), percent)
        return pd.DataFrame({"a": a, "b": b})

    pairs = classed.groupBy("bucket").applyInPandas(probe, "a long, b long").distinct()
    more = similar_pairs(pairs, rows, maps, words, percent, "probes")
    found = keep(components(edges.unionByName(more), "joined"), "components")
    out = signed.select("id", "n").join(found.where("id <> component").select("id", "component"), "id", "left")
    none = lambda c: F.when(c != _NO_ID, c)
    return out.select(none(F.col("id")).alias("doc_id"), F.col("n").alias("n_shingles"), none(F.coalesce("component", "id")).alias("component_id"))
