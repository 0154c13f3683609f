"""Byte-level BPE: whole pre-tokens by a minimal perfect hash, the rest by a heap over linked bytes.

Tier one resolves a pre-token that is itself a vocabulary entry: the hash gives its one slot,
a comparison with the bytes there decides. Tier two merges the bytes of a miss: a doubly linked
list of parts and a heap of (rank, place) of neighbouring pairs, lowest rank and leftmost first.
The vocabulary is a file of public ranks (bounded, under 1 MB); its tables are broadcast.
"""

from __future__ import annotations

import base64
import sys
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm import words as W
from contrail.llm.common import released

#: Bytes of pre-tokens and ids that a worker remembers (beyond, it forgets the older half),
#: characters of a pre-token that it remembers at most, and bytes of text that it takes at a time.
MEMO_BYTES, MEMO_LONGEST, BLOCK_BYTES = 56 << 20, 64, 1 << 20
#: What an entry of the memo takes besides its characters and ids: two objects (41 and 33 bytes, each
#: rounded up to 16) and a place in the table (35 on average).
_ENTRY = 130


#: A Mersenne prime, and a number to multiply with, for the hash of a key.
_PRIME, _FACTOR = (1 << 127) - 1, 0x5851F42D4C957F2D14057B7EF767814F


def _hashes(key: bytes) -> tuple[int, int]:
    """Two hashes of a key: its bytes after a leading one, as a number, times a factor, modulo a prime."""
    h = int.from_bytes(b"\1" + key) * _FACTOR % _PRIME
    return h & 0xFFFFFFFFFFFFFFFF, h >> 63


class PerfectHash:
    """Hash, displace: each bucket has a displacement that sends its keys to free slots of n.

    A bucket of one key stores its slot directly (as -slot - 1).
    """

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        self.buckets = max(1, n // 4)
        pairs = [_hashes(k) for k in keys]
        members: dict[int, list[int]] = {}
        for i, (a, _) in enumerate(pairs):
            members.setdefault(a % self.buckets, []).append(i)
        self.shift = [0] * self.buckets
        self.keys: list[bytes] = [b""] * n
        self.place = np.full(n, -1, np.int64)
        taken = np.zeros(n, dtype=bool)
        free = 0
        for bucket, ids in sorted(members.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(ids) == 1:
                while taken[free]:
                    free += 1
                slots, self.shift[bucket] = [free], -free - 1
            else:
                base = np.array([pairs[i][1] for i in ids], np.uint64)
                d0, slots = 1, None
                while slots is None:
                    d = np.arange(d0, d0 + 512, dtype=np.uint64)
                    at = (self._spread(base[None, :], d[:, None]) % np.uint64(n)).astype(np.int64)
                    ok = ~taken[at].any(axis=1)
                    for r in np.flatnonzero(ok):
                        if len(set(at[r].tolist())) == len(ids):
                            slots, self.shift[bucket] = at[r].tolist(), int(d[r])
                            break
                    d0 += 512
            for i, s in zip(ids, slots):
                taken[s] = True
                self.place[i] = s
                self.keys[s] = keys[i]

    @staticmethod
    def _spread(h: np.ndarray, d: np.ndarray) -> np.ndarray:
        x = h + d * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))

    def slot(self, key: bytes) -> int:
        """Slot of ``key``, or -1 if it is not one of the keys."""
        if not self.n:
            return -1
        a, h = _hashes(key)
        d = self.shift[a % self.buckets]
        if d < 0:
            s = -d - 1
        else:
            x = (h + d * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
            x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF
            s = (x ^ (x >> 32)) % self.n
        return s if self.keys[s] == key else -1


class Vocabulary:
    """Tables of a rank file: perfect hash over whole entries, ranks for merges, bytes for decoding."""

    def __init__(self, ranks: dict[bytes, int]):
        keys = list(ranks)
        self.ranks = ranks
        self.whole = PerfectHash(keys)
        self.ids = np.zeros(len(keys), np.int64)
        self.ids[self.whole.place] = [ranks[k] for k in keys]
        self.ids = self.ids.tolist()
        self.pieces = [b""] * (max(ranks.values(), default=-1) + 1)
        for k, r in ranks.items():
            self.pieces[r] = k
        # a merged part's rank is its id; so is a byte's (-1: none, such a byte must merge)
        self.one = [ranks.get(bytes([a]), -1) for a in range(256)]
        self.two = [ranks.get(bytes([a, b])) for a in range(256) for b in range(256)]
        self.holes = -1 in self.one

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})

    def encode(self, piece: bytes) -> list[int]:
        slot = self.whole.slot(piece)
        return [self.ids[slot]] if slot >= 0 else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token by merging neighbours, lowest rank and leftmost first."""
        n, get, two = len(piece), self.ranks.get, self.two
        ids = [self.one[b] for b in piece]  # id of the part that starts here, None once merged into its left
        ranks = [two[a << 8 | b] for a, b in zip(piece, piece[1:])]  # rank of that part with the next, if they merge
        ranks.append(None)
        end, back = list(range(1, n + 1)), list(range(-1, n))
        # rank and place of a pair in one number, which compares faster than two
        bits = n.bit_length()
        low = (1 << bits) - 1
        heap = [r << bits | i for i, r in enumerate(ranks) if r is not None]
        heapify(heap)
        while heap:
            pair = heappop(heap)
            i, r = pair & low, pair >> bits
            if ranks[i] != r:
                continue  # a part of this pair has changed since
            mid = end[i]
            stop = end[i] = end[mid]
            ids[i], ids[mid], ranks[mid], ranks[i] = r, None, None, None
            if stop < n:
                back[stop] = i
                ranks[i] = r = get(piece[i : end[stop]])
                if r is not None:
                    heappush(heap, r << bits | i)
            if i:
                i = back[i]
                ranks[i] = r = get(piece[i:stop])
                if r is not None:
                    heappush(heap, r << bits | i)
        if self.holes and -1 in ids:
            raise KeyError(piece)
        return [x for x in ids if x is not None]


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    made = array("I", ids)
    if sys.byteorder != "little":
        made.byteswap()
    return made.tobytes()


class _Memo(dict):
    """Packed ids of short pre-tokens already met, in two halves.

    A full half becomes the older one and the older one is forgotten; what is met again moves to
    the newer half, so frequent pre-tokens stay known however many rare ones pass.
    """

    def __init__(self, vocabulary: Vocabulary, size: int):
        self.vocabulary, self.half, self.bytes, self.older = vocabulary, size // 2, 0, {}

    def __missing__(self, token: str) -> bytes:
        got = self.older.get(token)
        if got is None:
            got = _packed(self.vocabulary.encode(token.encode()))
        if len(token) <= MEMO_LONGEST:
            size = _ENTRY + len(token) + len(got)
            if self.bytes + size > self.half:
                self.older, self.bytes = self.copy(), 0
                self.clear()
            self.bytes += size
            self[token] = got
        return got


def _spelt(pieces: pa.Array, ids: list[bytes], rows: int = 32) -> list[bytes]:
    """The bytes that each row's packed ids stand for: one lookup over some rows' ids, cut where the rows end."""
    out = []
    for lo in range(0, len(ids), rows):
        some = ids[lo : lo + rows]
        found = pieces.take(pa.array(np.frombuffer(b"".join(some), "<u4")))
        at = np.frombuffer(found.buffers()[1], np.int64)[found.offset : found.offset + len(found) + 1] if len(found) else np.zeros(1, np.int64)
        ends = at[np.cumsum([0, *(len(x) >> 2 for x in some)])].tolist()
        data = memoryview(found.buffers()[2] or b"")
        out += [bytes(data[a:b]) for a, b in zip(ends, ends[1:])]
    return out


def _extended(batch: pa.RecordBatch, columns: dict[str, list[bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, pa.binary()) for c in columns.values())], names=[*batch.schema.names, *columns])


def encode(docs: DataFrame, vocabulary: Vocabulary, pattern: str, text_col: str = "text", out: str = "ids", decoded: str | None = None, memo_bytes: int = MEMO_BYTES) -> DataFrame:
    """``docs`` with the ids of each whole text as a binary column of little-endian 32-bit integers.

    Each match of ``pattern`` is encoded by itself, special tokens are ordinary text. Null and
    empty texts give no ids. All columns are kept; one that is named like ``out`` is replaced.
    Rows do not depend on each other: repeated rows give repeated results, an empty table none.
    With ``decoded``, a column of that name holds the bytes that the ids stand for; one worker
    then does both, with one copy of the vocabulary. ``memo_bytes`` bounds the pre-tokens that a
    worker remembers.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kept = docs.drop(out, *([decoded] if decoded else []))
    schema = kept.select("*", *[F.lit(None).cast("binary").alias(c) for c in (out, decoded) if c]).schema

    def run(batches):
        import regex

        find, vocab = regex.compile(pattern).findall, shared.value
        memo, pieces = _Memo(vocab, memo_bytes), pa.array(vocab.pieces, pa.large_binary())
        for batch in batches:
            for block in W.blocks(batch, text_col, BLOCK_BYTES):
                ids = [b"".join(map(memo.__getitem__, find(t.as_py() or ""))) for t in block.column(text_col)]
                made = {out: ids}
                if decoded:
                    made[decoded] = _spelt(pieces, ids)
                yield _extended(block, made)

    return kept.mapInArrow(released(run), schema)


def decode(df: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the bytes that each row's ids stand for (binary); null ids decode to no bytes.

    Repeated rows give repeated results, an empty table none; a column named like ``out`` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    kept = df.drop(out)
    schema = kept.select("*", F.lit(None).cast("binary").alias(out)).schema

    def run(batches):
        pieces = pa.array(shared.value.pieces, pa.large_binary())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                block = batch.slice(at, 256)
                yield _extended(block, {out: _spelt(pieces, [x.as_py() or b"" for x in block.column(ids_col)])})

    return kept.mapInArrow(released(run), schema)
