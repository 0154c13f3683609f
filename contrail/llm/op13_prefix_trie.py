"""Prefix trie of conversations by ternary search trees over dictionary-encoded turns.

A turn (role, text) gets a number from a dictionary in the order of role and text. Conversations
become sequences of numbers, cut into segments of ``SEGMENT`` turns, so that no row holds a whole
long conversation; a segment is told by its level and a 128-bit sum of what stands before it, and
equal segments are counted once. Sorted and range partitioned, they go to shards. A shard builds
a ternary search tree (a node's key, smaller and larger siblings, children), inserting the median
sequence first, then those of each half, and adds up members, leaves and bytes from the last node
to the first, parents being older than their children.

Only nodes on the path of a shard's first or last sequence can have members in another shard.
These boundary nodes, at most two paths a shard, are merged by path; all others are complete as
they are. What lies below a segment's end (``deep``) comes from the levels below: every node
counts for its smallest member, and sums over the later segments of a conversation go to its
earlier ones.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contrail.llm.common import keep

#: Turns of a segment, and numbers (turns and sequence ends) of a shard.
SEGMENT, SHARD = 256, 200_000
#: Turns that conversations take over from the first of their five, at most.
HEAD, FAMILY = 8, 5
NO_ENDS = hashlib.sha256(b"").hexdigest()


# -- turns as numbers -----------------------------------------------------------------------


def encoded(conversations: DataFrame, parts: int) -> DataFrame:
    """(conv_id, pos, turn_id, size): turns in order, numbered from 0; size: UTF-8 bytes of the text.

    Turns stand by turn (null first), those of one turn by role and text. Rows without a conv_id
    belong to no conversation and are left out.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    told = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    told = told.withColumn("key", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)))
    distinct = told.groupBy("key").agg(F.min("role").alias("role"), F.min("text").alias("text"))
    ranked = distinct.repartitionByRange(parts, "role", F.substring("text", 1, 32)).sortWithinPartitions("role", "text")
    dictionary = keep(ranked.select("key", F.octet_length("text").cast("long").alias("size"), F.monotonically_increasing_id().alias("turn_id")), "turns")
    coded = told.select("conv_id", "turn", "key").join(dictionary, "key").select("conv_id", "turn", "turn_id", "size")
    return positions(coded, parts)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of each row among its conversation's rows of this part (rows sorted by conversation)."""
    from pyspark import TaskContext

    part, conv, n = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        ids = batch.column("conv_id").to_numpy(zero_copy_only=False)
        if not len(ids):
            continue
        start = np.concatenate([[True], ids[1:] != ids[:-1]])
        first = np.maximum.accumulate(np.where(start, np.arange(len(ids)), 0))
        place = np.arange(len(ids)) - first
        if ids[0] == conv:
            place[first == 0] += n
        conv, n = ids[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_pydict({"conv_id": batch.column("conv_id"), "part": pa.array(np.full(len(ids), part, np.int32)), "place": pa.array(place.astype(np.int64)),
                                          "turn_id": batch.column("turn_id"), "size": batch.column("size")})


def positions(coded: DataFrame, parts: int) -> DataFrame:
    """Number each conversation's rows without gathering it: places within range parts, plus what earlier parts hold."""
    dealt = coded.repartitionByRange(parts, "conv_id", F.col("turn").asc_nulls_first(), "turn_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "turn_id")
    placed = keep(dealt.select("conv_id", "turn_id", "size").mapInArrow(_number, "conv_id long, part int, place long, turn_id long, size long"), "turn-places")
    held = placed.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    moved = held.withColumn("earlier", F.sum("n").over(before)).where("earlier > 0").select("conv_id", "part", "earlier")
    # at most one conversation a part goes on from the part before: bounded by the number of parts
    return placed.join(F.broadcast(moved), ["conv_id", "part"], "left").select("conv_id", (F.col("place") + F.coalesce("earlier", F.lit(0))).alias("pos"), "turn_id", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns after every conversation takes over a head, and (conv_id, length) of all conversations.

    Conversation c starts with the first h = crc32(c) % 9 turns of conversation c - c % 5 (signs as
    in SQL), then come its own turns after its first h.
    """
    heads = turns.where(F.col("pos") < HEAD).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "turn_id", "size"))).alias("head"))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumn("h", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEAD + 1)).cast("int"))
    convs = convs.join(heads.select((F.col("conv_id")).alias("base"), "head"), F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("base"), "left")
    convs = convs.withColumn("head", F.when(F.col("head").isNotNull(), F.slice("head", 1, F.col("h")))).withColumn("taken", F.coalesce(F.size("head"), F.lit(0)))
    convs = convs.withColumn("taken", F.greatest("taken", F.lit(0)))
    convs = keep(convs.select("conv_id", "h", "head", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "heads")
    taken = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.turn_id", "t.size")
    own = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where(F.col("pos") >= F.col("h")).select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "turn_id", "size")
    return taken.unionByName(own), convs.select("conv_id", "length")


# -- segments ---------------------------------------------------------------------------------


def segments(turns: DataFrame, convs: DataFrame, size: int) -> DataFrame:
    """(conv_id, seg, ids, sizes, p1, p2, e1, e2, goes_on): every conversation's last segment is shorter than ``size``.

    (seg, p1, p2) tells what stands before the segment, (e1, e2) all up to its end.
    """
    turn = F.struct("pos", "turn_id", "size")
    rows = turns.select("conv_id", F.floor(F.col("pos") / size).alias("seg"), turn.alias("t"))
    rows = rows.unionByName(convs.select("conv_id", F.floor(F.col("length") / size).alias("seg"), F.lit(None).cast(rows.schema["t"].dataType).alias("t")))
    made = rows.groupBy("conv_id", "seg").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", "seg", F.col("t.turn_id").alias("ids"), F.col("t.size").alias("sizes"))
    made = keep(made.withColumn("h1", F.xxhash64("seg", "ids").cast("decimal(38,0)")).withColumn("h2", F.xxhash64(F.lit(1), "ids", "seg").cast("decimal(38,0)")), "segments")
    zero = F.lit(0).cast("decimal(38,0)")
    ordered = Window.partitionBy("conv_id").orderBy("seg")
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    chain = made.select("conv_id", "seg", "h1", "h2", F.size("ids").alias("n")).select(
        "conv_id", "seg", F.coalesce(F.sum("h1").over(earlier), zero).cast("decimal(38,0)").alias("p1"), F.coalesce(F.sum("h2").over(earlier), zero).cast("decimal(38,0)").alias("p2"),
        (F.coalesce(F.lead("n").over(ordered), F.lit(0)) > 0).alias("goes_on"))
    if made.where("seg > 0").isEmpty():  # nothing stands before any segment
        linked = made.withColumn("p1", zero).withColumn("p2", zero).withColumn("goes_on", F.lit(False))
    else:
        linked = made.join(chain, ["conv_id", "seg"])
    return linked.select("conv_id", "seg", "ids", "sizes", "p1", "p2", (F.col("p1") + F.col("h1")).cast("decimal(38,0)").alias("e1"),
                         (F.col("p2") + F.col("h2")).cast("decimal(38,0)").alias("e2"), "goes_on")


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, sha = None, None
    for batch in batches:
        done = []
        for a, b, conv in zip(*(batch.column(c).to_pylist() for c in ("e1", "e2", "conv_id"))):
            if (a, b) != now:
                if sha:
                    done.append((*now, sha.hexdigest()))
                now, sha = (a, b), hashlib.sha256(str(conv).encode())
            else:
                sha.update(b",%d" % conv)
        if done:
            yield _batch(done, _ENDS)
    if sha:
        yield _batch([(*now, sha.hexdigest())], _ENDS)


_ENDS = pa.schema([("e1", pa.string()), ("e2", pa.string()), ("ends", pa.string())])


def ends(segs: DataFrame, size: int, parts: int) -> DataFrame:
    """(e1, e2, ends): hash over the ids of the conversations that end in one place, in order, as they stream by."""
    last = segs.where(F.size("ids") < size).select(F.col("e1").cast("string").alias("e1"), F.col("e2").cast("string").alias("e2"), "conv_id")
    return last.repartition(parts, "e1", "e2").sortWithinPartitions("e1", "e2", "conv_id").mapInArrow(_hash_ids, "e1 string, e2 string, ends string")


# -- the shards' trees ------------------------------------------------------------------------


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


class Tree:
    """Ternary search tree; node 0 is the place before the first turn, nodes are older than their children."""

    def __init__(self):
        self.key, self.low, self.high, self.down, self.up = [0], [0], [0], [0], [-1]
        self.depth, self.size, self.n, self.least = [0], [0], [0], [None]

    def child(self, at: int, key: int, size: int) -> int:
        """The node of turn ``key`` below node ``at``, made if need be."""
        side, from_ = self.down, at
        node = self.down[at]
        while node:
            k = self.key[node]
            if key == k:
                return node
            side, from_ = (self.low, node) if key < k else (self.high, node)
            node = side[node]
        node = side[from_] = len(self.key)
        for column, value in ((self.key, key), (self.low, 0), (self.high, 0), (self.down, 0), (self.up, at), (self.depth, self.depth[at] + 1), (self.size, size), (self.n, 0), (self.least, None)):
            column.append(value)
        return node

    def insert(self, ids: list[int], sizes: list[int], n: int, least: int) -> int:
        """Add a sequence with its members; returns its last node."""
        node = 0
        self._count(node, n, least)
        for key, size in zip(ids, sizes):
            node = self.child(node, key, size)
            self._count(node, n, least)
        return node

    def _count(self, node: int, n: int, least: int) -> None:
        self.n[node] += n
        if self.least[node] is None or least < self.least[node]:
            self.least[node] = least


def medians(n: int) -> Iterator[int]:
    """0 to n - 1: the middle first, then the middles of both halves, and so on."""
    todo = [(0, n)]
    for lo, hi in todo:
        if lo < hi:
            mid = (lo + hi) // 2
            yield mid
            todo += [(lo, mid), (mid + 1, hi)]


_NODE = [("part", pa.int32()), ("node", pa.int64()), ("up", pa.int64()), ("seg", pa.int64()), ("p1", pa.string()), ("p2", pa.string()), ("path", pa.binary()), ("up_path", pa.binary()),
         ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()), ("size", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
         ("whole", pa.int64()), ("distinct", pa.int64()), ("leaf", pa.int64()), ("ends", pa.string())]
_NODE_SCHEMA = pa.schema(_NODE)
_NODE_DDL = ", ".join(f"`{n}` " + {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}[t] for n, t in _NODE)


def _subtrie(part: int, base: int, segment: int, key: tuple, rows: list[tuple], first: bool, last: bool) -> list[tuple]:
    """Nodes below one place in front of a segment, numbered from ``base``. Boundary nodes carry ``path`` and count only what is below them for good.

    A row: ids, sizes, n, least member, ends, deep children, deep leaves, deep savings.
    """
    tree, at_end = Tree(), {}
    for i in medians(len(rows)):
        at_end[tree.insert(*rows[i][:4])] = rows[i][4:]
    path: dict[int, bytes] = {}
    for row in ([rows[0]] if first else []) + ([rows[-1]] if last else []):
        node, text = 0, b""
        path[0] = hashlib.blake2b(text, digest_size=16).digest()
        for x, s in zip(row[0], row[1]):
            node, text = tree.child(node, x, s), text + x.to_bytes(8, "little", signed=True)
            path[node] = hashlib.blake2b(text, digest_size=16).digest()
    n = len(tree.key)
    kids, leaves, whole, distinct, out = [0] * n, [0] * n, [0] * n, [0] * n, []
    for i in range(n - 1, -1, -1):
        said, deep_kids, deep_leaves, deep_saved = at_end.get(i, (None, 0, 0, 0))
        kids[i] += deep_kids
        leaf = int(not kids[i])
        leaves[i] += deep_leaves + (leaf if i not in path else 0)
        whole[i] += tree.n[i] * tree.size[i] + deep_saved
        distinct[i] += tree.size[i] if i not in path else 0
        up = tree.up[i]
        if up >= 0:
            kids[up] += i not in path
            leaves[up] += leaves[i]
            whole[up] += whole[i]
            distinct[up] += distinct[i]
        known = up >= 0 and up not in path
        out.append((part, base + i if i in path else None, base + up if up in path else None, *key, path.get(i), path.get(up) if i in path else None, key[0] * segment + tree.depth[i], tree.least[i],
                    tree.least[up] if known else None, tree.size[i], tree.n[i], kids[i], leaves[i], whole[i], distinct[i], leaf, said))
    return out


def _trees(segment: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, base, key, held, first = TaskContext.get().partitionId(), 0, None, [], True
        for batch in batches:
            out = []
            for *now, ids, sizes, n, least, said, kids, leaves, saved in zip(*(c.to_pylist() for c in batch.columns)):
                if tuple(now) != key:
                    if held:
                        made = _subtrie(part, base, segment, key, held, first, False)
                        out += made
                        base, first = base + len(made), False
                    key, held = tuple(now), []
                held.append((ids, sizes, n, least, said, kids, leaves, saved))
            if out:
                yield _batch(out, _NODE_SCHEMA)
        if held:
            yield _batch(_subtrie(part, base, segment, key, held, first, True), _NODE_SCHEMA)

    return run


def _merged(pdf):
    """Boundary nodes of one place in front of a segment, from all shards: one entry for each path."""
    import pandas as pd

    own = pdf.groupby("path").agg(up_path=("up_path", "first"), depth=("depth", "first"), conv_id=("conv_id", "min"), size=("size", "first"), n_convs=("n_convs", "sum"), n_children=("n_children", "sum"),
                                  n_leaves=("n_leaves", "sum"), whole=("whole", "sum"), distinct=("distinct", "sum"), ends=("ends", "first"), part=("part", "min")).sort_values("depth", ascending=False)
    nodes = own.to_dict("index")
    extra = {p: [0, 0] for p in nodes}  # leaves and bytes of the boundary nodes at and below each
    for p, x in nodes.items():
        x["leaf"] = int(x["n_children"] == 0)
        extra[p][0] += x["leaf"]
        extra[p][1] += x["size"]
        if isinstance(up := x["up_path"], bytes):
            nodes[up]["n_children"] += 1
            extra[up][0] += extra[p][0]
            extra[up][1] += extra[p][1]
    for p, x in nodes.items():
        x["n_leaves"] += extra[p][0]
        x["distinct"] += extra[p][1]
        x["parent_conv_id"] = nodes[x["up_path"]]["conv_id"] if isinstance(x["up_path"], bytes) else None
    out = pdf[["part", "node", "up", "seg", "p1", "p2", "path", "up_path"]].copy()
    for c in ("depth", "conv_id", "parent_conv_id", "size", "n_convs", "n_children", "n_leaves", "whole", "distinct", "leaf", "ends"):
        out[c] = pd.Series([nodes[p][c] for p in pdf["path"]], index=pdf.index, dtype=object)
    out["emitted"] = [nodes[p]["part"] == part for p, part in zip(pdf["path"], pdf["part"])]
    return out


def nodes(rows: DataFrame, segment: int, shard: int) -> DataFrame:
    """Nodes of distinct segments: seg, p1, p2, root, depth, conv_id, parent_conv_id, counts, own savings, leaf, ends.

    ``rows``: seg, p1, p2, ids, sizes, n, least, ends, deep_children, deep_leaves, deep_saved.
    """
    rows = keep(rows, "distinct-segments")
    total = rows.agg(F.sum(F.size("ids") + 1)).first()[0] or 0
    key = ["seg", "p1", "p2", "ids"]
    dealt = rows.repartitionByRange(max(1, math.ceil(total / shard)), *key).sortWithinPartitions(*key).select(
        "seg", "p1", "p2", "ids", "sizes", "n", "least", "ends", "deep_children", "deep_leaves", "deep_saved")
    local = keep(dealt.mapInArrow(_trees(segment), _NODE_DDL), "trie-shards")
    merged = keep(local.where("path is not null").groupBy("seg", "p1", "p2").applyInPandas(_merged, _NODE_DDL + ", emitted boolean"), "trie-boundary")
    parents = merged.select("part", F.col("node").alias("up"), F.col("conv_id").alias("up_conv"))
    inner = local.where("path is null").join(parents, ["part", "up"], "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv"))
    found = inner.drop("up_conv").unionByName(merged.where("emitted").drop("emitted"))
    return found.select("seg", "p1", "p2", (F.col("depth") == F.col("seg") * segment).alias("root"), "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        (F.col("whole") - F.col("distinct")).alias("saved_tokens"), ((F.col("n_convs") - 1) * F.col("size")).alias("own_saved"), "leaf", "ends")


def trie(conversations: DataFrame, segment: int = SEGMENT, shard: int = SHARD) -> DataFrame:
    """One row per trie node of the rebuilt conversations, told by (conv_id, depth).

    Null roles and texts are empty. Rows without a conv_id are left out; an empty table has no
    node. Conversations without turns are members of the root. Equal rows are turns of their own.
    """
    spark = conversations.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    turns, convs = rebuilt(encoded(conversations, parts))
    segs = segments(turns, convs, segment)
    deep = not segs.where("seg > 0").isEmpty()
    zero = F.lit(0).cast("long")
    said = ends(segs, segment, parts)

    def distinct(rows: DataFrame, *sums) -> DataFrame:
        made = rows.groupBy("seg", F.col("p1").cast("string").alias("p1"), F.col("p2").cast("string").alias("p2"), "ids").agg(
            F.min("sizes").alias("sizes"), F.count("*").alias("n"), F.min("conv_id").alias("least"), F.min(F.col("e1").cast("string")).alias("e1"), F.min(F.col("e2").cast("string")).alias("e2"), *sums)
        return made.join(said, ["e1", "e2"], "left")

    first = nodes(distinct(segs, F.max(F.col("goes_on").cast("long")).alias("deep_children"), F.max(zero).alias("deep_leaves"), F.max(zero).alias("deep_saved")), segment, shard)
    if deep:
        first = keep(first, "trie-levels")
        given = first.where("not root or seg = 0").groupBy("conv_id", "seg").agg(F.sum("leaf").alias("leaves"), F.sum("own_saved").alias("saved"))
        later = Window.partitionBy("conv_id").orderBy(F.col("seg").desc()).rowsBetween(Window.unboundedPreceding, -1)
        below = segs.select("conv_id", "seg").join(given, ["conv_id", "seg"], "left").select(
            "conv_id", "seg", F.coalesce(F.sum("leaves").over(later), zero).alias("leaves"), F.coalesce(F.sum("saved").over(later), zero).alias("saved"))
        again = distinct(segs.join(below, ["conv_id", "seg"]), F.sum("leaves").alias("deep_leaves"), F.sum("saved").alias("deep_saved"))
        roots = first.where("root and seg > 0").select((F.col("seg") - 1).alias("seg"), F.col("p1").alias("e1"), F.col("p2").alias("e2"), F.col("n_children").alias("deep_children"), F.col("ends").alias("root_ends"))
        again = again.join(roots, ["seg", "e1", "e2"], "left").withColumn("ends", F.coalesce("ends", "root_ends")).withColumn("deep_children", F.coalesce("deep_children", zero))
        first = nodes(again, segment, shard).where("not root or seg = 0")
    return first.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"))
