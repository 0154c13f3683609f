"""Language-model scoring with an n-gram trie: Elias-Fano pointers and quantised smoothed values.

The model is a trigram one that adds the counts of shorter contexts to those of longer ones:

    p(w|u,v) = (c(uvw) + B2 (c(vw) + B1 (c(w) + 0.1))) / (c(uv) + B2 (c(v) + B1 Z)),
    Z = N + 0.1 (V + 1),

which sums to one over the vocabulary and an unknown word. Contexts u and v are classes: each of
the frequent words (a share of 1/CLASSES of the tokens or more, so at most CLASSES of them) is a
class of its own, all others share POOLS hashed classes. Predicted words are never pooled.

The numerator needs only counts of w with what stands before it, the denominator only counts of
v with what stands before it. So the log probability of a text is a sum over its tokens of terms
that the shard of the token's class can work out alone, and one exchange carries every token
once: tasks sort their tokens by shard, word and context and send packed arrays; a shard builds
its part of the trie (words, their left neighbours, the neighbours' left neighbours) from the
training tokens, looks up all tokens in it, and returns sums for each text. Words so frequent
that one shard would get too much (1/HOT of the tokens) are spread by left neighbour as well;
their total counts are known from the counting pass, at most HOT of them.

A shard's levels lie in one anonymous memory map: pointers to the children of each node are
monotone and Elias-Fano coded, children are 16-bit classes in order within their context, found
by successor search in the context's range, and each node has its log10 values in 16 bits.
"""

from __future__ import annotations

import math
import mmap
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import words as W
from contrail.llm.common import fold, give_back, keep, mix64, released

CLASSES, POOLS = 49_152, 16_383
START = CLASSES + POOLS
HOT = 256
#: Weight of shorter contexts: B1 is MU1 / Z, B2 a plain factor.
MU1, B2 = 100.0, 0.02
#: Text bytes a shard and a bucket of documents, which bound a task's arrays; documents a bucket.
SHARD_BYTES, BUCKET_BYTES, BUCKET_DOCS = 8 << 20, 32 << 20, 50_000
END = np.uint64(0xE5D0E5D0E5D0E5D1)
_NO_ID = -(1 << 63)
_LOW, _STEP = -12.0, 32.0 / 65536  # log10 values from -12 to 20 in steps of 0.0005


# -- Elias-Fano -----------------------------------------------------------------------------

_SELECT = np.array([[([i for i in range(8) if b >> i & 1] + [0] * 8)[r] for r in range(8)] for b in range(256)], np.int64)


class EliasFano:
    """Non-decreasing integers: low bits packed, high bits as a unary bit vector with counts per word."""

    def __init__(self, values: np.ndarray):
        v = values.astype(np.uint64)
        n = self.n = len(v)
        top = int(v[-1]) if n else 0
        self.width = width = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
        low = v & np.uint64((1 << width) - 1)
        self.low = np.zeros((n * width >> 6) + 2, np.uint64)
        if width and n:
            at = np.arange(n, dtype=np.int64) * width
            word, shift = at >> 6, (at & 63).astype(np.uint64)
            first = np.flatnonzero(np.diff(word, prepend=-1))
            self.low[word[first]] = np.add.reduceat(low << shift, first)
            over = np.flatnonzero(shift + np.uint64(width) > 64)
            self.low[word[over] + 1] |= low[over] >> (np.uint64(64) - shift[over])
        place = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
        size = (int(place[-1]) if n else 0) // 64 + 1
        bits = np.zeros(size * 64, dtype=bool)
        bits[place] = True
        self.high = np.packbits(bits, bitorder="little")
        self.counts = np.concatenate([[0], np.cumsum(np.bitwise_count(self.high.view(np.uint64)).astype(np.int64))])

    def get(self, i: np.ndarray) -> np.ndarray:
        """Values at the places ``i``: select in the high bits, then the packed low bits."""
        if not len(i):
            return np.zeros(0, np.int64)
        word = np.searchsorted(self.counts, i, side="right") - 1
        eight = self.high.reshape(-1, 8)[word]
        run = np.cumsum(np.bitwise_count(eight).astype(np.int64), axis=1)
        left = i - self.counts[word]
        byte = (run <= left[:, None]).sum(axis=1)
        rows = np.arange(len(i))
        left = left - np.where(byte > 0, run[rows, byte - 1], 0)
        high = word * 64 + byte * 8 + _SELECT[eight[rows, byte], left] - i
        if not self.width:
            return high
        at = i.astype(np.int64) * self.width
        w, s = at >> 6, (at & 63).astype(np.uint64)
        low = self.low[w] >> s
        over = (s + np.uint64(self.width)) > 64
        low[over] |= self.low[w[over] + 1] << (np.uint64(64) - s[over])
        return (high << self.width) | (low & np.uint64((1 << self.width) - 1)).astype(np.int64)


def mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """Read-only views of copies of the arrays in one anonymous memory map."""
    sizes = [-(-a.nbytes // 8) * 8 for a in arrays]
    space = mmap.mmap(-1, max(8, sum(sizes)))
    out, at = [], 0
    for a, size in zip(arrays, sizes):
        view = np.frombuffer(space, a.dtype, len(a), at) if len(a) else a
        if len(a):
            view[:] = a
            view.flags.writeable = False
        out.append(view)
        at += size
    return out


def quantise(x: np.ndarray) -> np.ndarray:
    return np.clip(np.rint((x - _LOW) / _STEP), 0, 65535).astype(np.uint16)


def restore(q: np.ndarray) -> np.ndarray:
    return q.astype(np.float64) * _STEP + _LOW


class Level:
    """Children of the nodes above: ``keys`` are parent * 65536 + class, sorted; one value a child."""

    def __init__(self, parents: int, keys: np.ndarray, values: np.ndarray):
        ends = np.searchsorted(keys, np.arange(parents + 1, dtype=np.int64) << 16)
        self.pointers = p = EliasFano(ends)
        p.low, p.high, p.counts, self.child, self.value = mapped(
            [p.low, p.high, p.counts, (keys & 0xFFFF).astype(np.uint16), quantise(values)])

    def find(self, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Places of the children, -1 where a context has none such; ``parent`` is -1 for no context."""
        out = np.full(len(parent), -1, np.int64)
        known = np.flatnonzero(parent >= 0)
        if not len(known) or not len(self.child):
            return out
        nodes, which = np.unique(parent[known], return_inverse=True)
        lo, end, want = self.pointers.get(nodes)[which], self.pointers.get(nodes + 1)[which], child[known]
        hi = end.copy()
        while (open_ := lo < hi).any():  # successor search within the context's range
            mid = (lo + hi) >> 1
            less = (self.child[np.minimum(mid, len(self.child) - 1)] < want) & open_
            lo, hi = np.where(less, mid + 1, lo), np.where(less | ~open_, hi, mid)
        got = (lo < end) & (self.child[np.minimum(lo, len(self.child) - 1)] == want)
        out[known[got]] = lo[got]
        return out


# -- counting pass --------------------------------------------------------------------------


def _packed(*arrays: np.ndarray) -> bytes:
    head = np.array([len(arrays), *[x for a in arrays for x in (a.itemsize, len(a))]], np.int64).tobytes()
    raw = head + b"".join(a.tobytes() for a in arrays)
    return np.int64(len(raw)).tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], int(np.frombuffer(blob[:8], np.int64)[0]), codec="zstd", asbytes=True)
    n = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, 1 + 2 * n)[1:]
    out, at = [], 8 + 16 * n
    for size, count in zip(head[::2], head[1::2]):
        out.append(np.frombuffer(raw, f"u{size}", int(count), at))
        at += int(size * count)
    return out


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    uniq, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return uniq, np.bincount(inverse, np.concatenate(counts), len(uniq)).astype(np.int64)


def _training_words(shards: int):
    def send(keys, counts):
        u, c = _merged(keys, counts)
        cut = np.searchsorted(u, (np.arange(1, shards, dtype=np.uint64) * np.uint64((1 << 64) // shards))) if shards > 1 else []
        rows = [(s, _packed(a, b.astype(np.uint32))) for s, (a, b) in enumerate(zip(np.split(u, cut), np.split(c, cut))) if len(a)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["shard", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for batch in batches:
            batch = batch.filter(pa.array(~np.asarray(batch.column("held_out"))))
            for block in W.blocks(batch):
                u, c = np.unique(W.split(block.column("text")).hash, return_counts=True)
                keys += [u, np.array([END])]
                counts += [c, np.array([len(block)])]
                held += len(u)
            if held > 3_000_000:
                u, c = _merged(keys, counts)
                keys, counts, held = [u], [c], 0
                if len(u) > 2_000_000:
                    yield from send(keys, counts)
                    keys, counts = [], []
        yield from send(keys, counts)

    return run


def _word_totals(pdf: pd.DataFrame) -> pd.DataFrame:
    """A summary row (word null) and the words that may be frequent in the whole corpus."""
    u, c = _merged(*zip(*[_unpacked(x) for x in pdf["counts"]]))
    often = c * CLASSES >= c.sum()
    return pd.DataFrame({"word": pd.array([None, *u[often].view(np.int64)], "Int64"), "n": [int(c.sum()), *c[often]], "distinct": [len(u), *([0] * int(often.sum()))]})


class Frequent:
    """Counts of the frequent words, by rank; totals of the training tokens."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, n: int, v: int, texts: int):
        order = np.argsort(words)
        self.words, self.rank = words[order], order.astype(np.uint16)
        self.counts, self.n, self.v, self.texts = counts, n, v, texts

    def classes(self, h: np.ndarray) -> np.ndarray:
        pool = (CLASSES + (mix64(h) >> np.uint64(17)) % np.uint64(POOLS)).astype(np.uint16)
        if not len(self.words):
            return pool
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.rank[at], pool)

    def hot(self) -> int:
        """Ranks below this are spread over the shards."""
        return int(np.count_nonzero(self.counts * HOT >= max(self.n, 1)))


# -- exchange -------------------------------------------------------------------------------


def _route(cls: np.ndarray, left: np.ndarray, hot: int, shards: int) -> np.ndarray:
    key = cls.astype(np.uint64) << np.uint64(20)
    key = key + np.where(cls < hot, left.astype(np.uint64) + np.uint64(1), np.uint64(0))
    return (mix64(key + np.uint64(77)) % np.uint64(shards)).astype(np.int64)


def _messages(frequent, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = frequent.value
        hot = f.hot()
        for batch in batches:
            for block in W.blocks(batch, size=6 << 20):
                words = W.split(block.column("text"))
                n_rows = len(block)
                rows = np.concatenate([words.row, np.arange(n_rows)])
                h = np.concatenate([words.hash, np.full(n_rows, END)])
                order = np.argsort(rows, kind="stable")  # the end stands after its text's words
                rows, h = rows[order], h[order]
                uniq, word = np.unique(h, return_inverse=True)
                cls = f.classes(uniq)[word]
                left = np.full(len(rows), START, np.uint16)
                left2 = left.copy()
                left[1:] = np.where(rows[1:] == rows[:-1], cls[:-1], START)
                left2[2:] = np.where(rows[2:] == rows[:-2], cls[:-2], START)
                key = word.astype(np.int64) << 32 | left.astype(np.int64) << 16 | left2
                shard = _route(cls, left, hot, shards)
                order = np.argsort(key, kind="stable")
                order = order[np.argsort(shard[order], kind="stable")]
                at, blobs = np.flatnonzero(np.diff(shard[order], prepend=-1)), []
                ids = block.column("doc_id").fill_null(_NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
                out = np.asarray(block.column("held_out"))
                for lo, hi in zip(at, [*at[1:], len(order)]):
                    part = order[lo:hi]
                    docs, doc = np.unique(rows[part], return_inverse=True)
                    here, runs = np.unique(word[part], return_counts=True)
                    blobs.append(_packed(uniq[here], runs.astype(np.uint32), left[part], left2[part],
                                         doc.astype(np.uint16 if len(docs) < 65536 else np.uint32), ids[docs].view(np.uint64), out[docs].astype(np.uint8)))
                yield pa.RecordBatch.from_arrays([pa.array(shard[order][at], pa.int32()), pa.array(blobs, pa.binary())], names=["shard", "tokens"])

    return run


def _runs(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of sorted keys and the sums of ``n`` over each."""
    if not len(keys):
        return keys, n
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[first], np.add.reduceat(n, first)


def shard_scores(parts: list[list[np.ndarray]], f: Frequent, mu1: float, b2: float) -> dict[str, np.ndarray]:
    """Sums for each text over a shard's tokens: tokens, known tokens, base and model log10 terms."""
    z = f.n + 0.1 * (f.v + 1)
    b1 = mu1 / z
    words, word = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    at = np.cumsum([0] + [len(p[0]) for p in parts])
    w = np.concatenate([np.repeat(word[a : a + len(p[0])].astype(np.int32), p[1]) for a, p in zip(at, parts)])
    v = np.concatenate([p[2] for p in parts])
    u = np.concatenate([p[3] for p in parts])
    ids, doc = np.unique(np.concatenate([p[5] for p in parts]).view(np.int64), return_inverse=True)
    at = np.cumsum([0] + [len(p[5]) for p in parts])
    held = np.concatenate([p[6][p[4]] for p in parts]).astype(bool)
    d = np.concatenate([doc[a : a + len(p[5])].astype(np.int32)[p[4]] for a, p in zip(at, parts)])

    parts.clear()
    key = w.astype(np.int64) << 32 | v.astype(np.int64) << 16 | u
    del u, v
    key, back = np.unique(key, return_inverse=True)
    back = back.astype(np.int32)
    n3 = np.bincount(back[~held], minlength=len(key)).astype(np.int64)  # training count of each trigram met
    cls = f.classes(words)
    is_end = words == END
    n1 = np.bincount(key >> 32, n3, len(words)).astype(np.int64)
    exact = cls < f.hot()  # those words' tokens are spread, their counts known
    n1[exact] = f.counts[cls[exact]]

    # what predicts the word: word > left neighbour > the one before it
    two, c2 = _runs(key >> 16, n3)
    seen2, seen3 = c2 > 0, n3 > 0
    low1 = b1 * (n1 + 0.1)
    k2, k3 = two[seen2], key[seen3]
    parent3 = np.searchsorted(k2, k3 >> 16)
    one = quantise(np.log10(b2 * low1))
    mid = b2 * (c2[seen2] + low1[k2 >> 16])
    level2 = Level(len(words), k2, np.log10(mid))
    level3 = Level(len(k2), parent3.astype(np.int64) << 16 | (k3 & 0xFFFF), np.log10(n3[seen3] + mid[parent3]))
    # what the word's class tells of the next word: class > left neighbour
    groups, group = np.unique(cls, return_inverse=True)
    g1 = np.bincount(group, np.where(is_end, 0, n1), len(groups))
    gkey, gback = np.unique(group[two >> 16].astype(np.int64) << 16 | (two & 0xFFFF), return_inverse=True)
    g2 = np.bincount(gback, np.where(is_end[two >> 16], 0, c2), len(gkey))
    low = b2 * (g1 + b1 * z)
    alone = quantise(np.log10(low))
    context = Level(len(groups), gkey[g2 > 0], np.log10(g2[g2 > 0] + low[gkey[g2 > 0] >> 16]))

    kw = key >> 32
    pair, which = np.unique(key >> 16, return_inverse=True)
    at2 = level2.find(pair >> 16, pair & 0xFFFF)
    atc = context.find(group[pair >> 16], pair & 0xFFFF)
    at3 = level3.find(at2[which], key & 0xFFFF)
    top = one[kw]
    if len(level2.value):
        top = np.where(at2[which] >= 0, level2.value[at2[which]], top)
    if len(level3.value):
        top = np.where(at3 >= 0, level3.value[at3], top)
    under = alone[group[pair >> 16]]
    if len(context.value):
        under = np.where(atc >= 0, context.value[atc], under)
    first = math.log10(f.texts + b2 * (f.texts + b1 * z))  # the context of a text's first token
    term = restore(top) - np.where(is_end[kw], first, restore(under)[which])
    size = len(ids)
    return {"doc_id": ids, "n_tokens": np.bincount(d, minlength=size), "n_known": np.bincount(d, n1[w] > 0, size).astype(np.int64),
            "base": np.bincount(d, np.log10(n1 + 0.1)[w], size), "score": np.bincount(d, term[back], size)}


_PART = (np.uint32, np.uint32, np.float64, np.float32)  # n_tokens, n_known, base, score


def add_up(parts: Iterator[list[np.ndarray]], most: int = 400_000) -> tuple[np.ndarray, np.ndarray]:
    """Document ids and their four sums; ``parts`` are merged whenever more than ``most`` entries wait."""
    ids, sums = np.zeros(0, np.int64), np.zeros((len(_PART), 0))
    held, waiting = [], 0
    for part in chain(parts, [None]):
        if part is not None:
            held.append(part)
            waiting += len(part[0])
        if held and (part is None or waiting > most):
            ids, back = np.unique(np.concatenate([ids, *[p[0].view(np.int64) for p in held]]), return_inverse=True)
            sums = np.stack([np.bincount(back, np.concatenate([sums[k], *[p[k + 1].view(kind) for p in held]]), len(ids))
                             for k, kind in enumerate(_PART)])
            held, waiting = [], 0
    return ids, sums


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text", mu1: float = MU1, b2: float = B2) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each text.

    ``held_out`` is a column of ``docs``; rows where it is false are the training texts. Null and
    empty texts have one token, their end. Rows that share an id (nulls too) count as one document:
    their tokens are added up. With no training text all counts are 0. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"))
    size = docs.agg(F.sum(F.octet_length(text_col)).alias("b"), F.count("*").alias("n")).first()
    shards = max(1, -(-(size.b or 0) // SHARD_BYTES))
    totals = keep(rows.mapInArrow(released(_training_words(shards)), "shard int, counts binary")
                  .repartition(shards, "shard").groupBy("shard").applyInPandas(_word_totals, "word long, n long, distinct long"), "lm-words")
    s = totals.where("word is null").agg(F.sum("n").alias("n"), F.sum("distinct").alias("v")).first()
    n, v = s.n or 0, s.v or 0
    often = totals.where(F.col("word").isNotNull() & (F.col("n") * CLASSES >= n)).sort(F.desc("n"), "word").toPandas()  # at most CLASSES rows
    held = often.set_index("word")["n"]
    ends = totals.where(F.col("word") == int(END.view(np.int64))).first()
    texts = int(ends.n) if ends else rows.where("not held_out").count()
    frequent = spark.sparkContext.broadcast(Frequent(held.index.to_numpy(np.int64).view(np.uint64), held.to_numpy(np.int64), n, v, max(texts, 1)))
    buckets = max(1, -(-size.n // BUCKET_DOCS), -(-(size.b or 0) // BUCKET_BYTES))

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        x = shard_scores([_unpacked(b) for b in pdf["tokens"]], frequent.value, mu1, b2)
        at = (mix64(x["doc_id"].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        cut = np.flatnonzero(np.diff(at[order], prepend=-1))
        blobs = []
        for part in np.split(order, cut[1:]):
            part = part[np.argsort(x["doc_id"][part])]
            blobs.append(_packed(x["doc_id"][part].view(np.uint64), x["n_tokens"][part].astype(np.uint32), x["n_known"][part].astype(np.uint32),
                                 x["base"][part].view(np.uint64), x["score"][part].astype(np.float32).view(np.uint32)))
        give_back()
        return pd.DataFrame({"bucket": at[order][cut].astype(np.int32), "sums": blobs})

    def bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, sums = add_up(_unpacked(b) for b in pdf["sums"])
        give_back()
        return pd.DataFrame({"doc_id": pd.arrays.IntegerArray(ids, ids == _NO_ID), "n_tokens": sums[0].astype(np.int64),
                             "n_known": sums[1].astype(np.int64), "base_score": sums[2], "score": sums[3]})

    sums = (rows.mapInArrow(released(_messages(frequent, shards)), "shard int, tokens binary").repartition(shards, "shard").groupBy("shard").applyInPandas(shard, "bucket int, sums binary")
            .repartition(buckets, "bucket").groupBy("bucket").applyInPandas(bucket, "doc_id long, n_tokens long, n_known long, base_score double, score double"))
    z = math.log10(n + 0.1 * (v + 1))
    return sums.select("doc_id", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
                       (F.col("base_score") - F.col("n_tokens") * F.lit(z)).alias("base_score"), F.col("score"))


def held_out(doc_id):
    return fold(doc_id, 10) == 0
