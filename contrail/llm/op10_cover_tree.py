"""Embedding near-dedup: exact threshold pairs by dual traversal of cover trees.

Unit vectors are compared by chord distance: cosine >= c means distance <= sqrt(2 - 2c). Equal
vectors are one from the start. The others of a label are dealt into blocks, and each pair of
blocks of a label is a task with two cover trees: nested levels whose radii halve, each node with
the distance to its farthest member. A dual traversal descends pairs of nodes and drops a pair
when the distance of the centres exceeds both covering radii and the threshold together, so that
no pair at the threshold is lost; a node is held against all nodes near its parent in one product.

A task returns a row for each linked vector: how many it is linked to, and the smallest id that
the task's own links reach. Pairs themselves are never written out, and a label of any size is
only ever spread over more tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import components, hot_join, keep

COSINE = 0.93
BLOCK = 2048
LEVELS = 8
#: Members compared at once when a cover is built, and rows of a product in the traversal.
HEADS = 128
ROWS = 512
_NO_ID = (1 << 63) - 1
_SLACK = 1e-7


@dataclass
class Node:
    centre: int
    radius: float
    children: list[Node] = field(default_factory=list)


def _balls(x: np.ndarray, members: np.ndarray, centre: int, radius: float):
    """Greedy cover of ``members``: (head, those within ``radius`` of it and of no head before), ``centre`` first.

    Distances are taken to the next few members at once, as every member may turn out a head.
    """
    left = np.concatenate([[centre], members[members != centre]])
    while len(left):
        heads = left[:HEADS]
        near = np.sqrt(np.maximum(2 - 2 * (x[left] @ x[heads].T), 0)) <= radius
        free = np.ones(len(left), bool)
        for k, head in enumerate(heads):
            if free[k]:
                near[k, k] = True
                yield int(head), left[near[:, k] & free]
                free &= ~near[:, k]
        left = left[free]


def cover_tree(x: np.ndarray, members: np.ndarray | None = None, centre: int = 0, level: int = 0) -> Node:
    """Tree over the rows of ``x`` (unit vectors); leaves are single rows."""
    members = np.arange(len(x)) if members is None else members
    if len(members) == 1:
        return Node(centre, 0.0)
    node = Node(centre, float(np.sqrt(np.maximum(2 - 2 * (x[members] @ x[centre]), 0)).max()))
    if level == LEVELS:
        node.children = [Node(int(i), 0.0) for i in members]
        return node
    node.children = [cover_tree(x, near, head, level + 1) for head, near in _balls(x, members, centre, 2.0 / 2 ** (level + 1))]
    if len(node.children) == 1:  # the same members: take the finer node
        return node.children[0]
    return node


@dataclass
class Flat:
    """A tree as arrays: the children of node n are first[n] to first[n] + count[n] - 1."""

    centre: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, root: Node) -> Flat:
        nodes, first = [root], []
        for node in nodes:  # grows while it is read: level by level
            first.append(len(nodes))
            nodes.extend(node.children)
        return cls(np.array([n.centre for n in nodes]), np.array([n.radius for n in nodes]), np.array(first), np.array([len(n.children) for n in nodes]))

    def below(self, nodes: np.ndarray) -> np.ndarray:
        """The children of inner nodes."""
        n = self.count[nodes]
        return np.repeat(self.first[nodes] - np.cumsum(n) + n, n) + np.arange(n.sum())


def threshold_pairs(x: np.ndarray, y: np.ndarray | None, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with x[i] . y[j] >= cosine; with y None, all i < j within x.

    A step compares a set of nodes of one tree with a set of nodes of the other in one product, both
    sets being disjoint subtrees. An inner node goes on with its children against all that is
    near it; the leaves go on together against the children of the inner nodes near any of them.
    """
    same = y is None
    y = x if same else y
    reach = np.sqrt(max(2 - 2 * cosine, 0.0)) + _SLACK
    out_i, out_j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if not len(x) or not len(y):
        return out_i[0], out_j[0]
    a = Flat.of(cover_tree(x))
    b = a if same else Flat.of(cover_tree(y))
    stack = [(np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        left, right = stack.pop()
        if len(left) > ROWS:
            stack.append((left[ROWS:], right))
            left = left[:ROWS]
        lc, rc = a.centre[left], b.centre[right]
        l_leaf, r_leaf = a.count[left] == 0, b.count[right] == 0
        dots = x[lc] @ y[rc].T
        # the distance of the centres, squared, against the squares of the sums of radii
        near = 2 - 2 * dots <= (a.radius[left][:, None] + (b.radius[right] + reach)[None, :]) ** 2
        i, j = np.nonzero((dots >= cosine) & l_leaf[:, None] & r_leaf[None, :])
        keep_pair = lc[i] < rc[j] if same else slice(None)
        out_i.append(lc[i][keep_pair])
        out_j.append(rc[j][keep_pair])
        open_ = near & ~r_leaf[None, :]
        rows = np.nonzero(l_leaf & open_.any(axis=1))[0]
        if len(rows):
            stack.append((left[rows], b.below(right[open_[rows].any(axis=0)])))
        for p in np.nonzero(~l_leaf & near.any(axis=1))[0]:
            stack.append((a.below(left[p : p + 1]), np.concatenate([right[near[p] & r_leaf], b.below(right[open_[p]])])))
    return np.concatenate(out_i), np.concatenate(out_j)


def _smallest(n: int, i: np.ndarray, j: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id that each of n nodes reaches over the links."""
    low = ids.copy()
    while len(i):
        m = np.minimum(low[i], low[j])
        before = low.copy()
        np.minimum.at(low, i, m)
        np.minimum.at(low, j, m)
        if (low == before).all():
            break
    return low


def _block_pair(cosine: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p, q = int(pdf["p"].iloc[0]), int(pdf["q"].iloc[0])
        pdf = pdf.sort_values("id")
        first, second = pdf[pdf["block"] == p], pdf[pdf["block"] == q] if p != q else pdf.iloc[:0]

        def unit(rows):
            x = np.array(rows["embedding"].tolist(), np.float64).reshape(len(rows), -1)
            return x / np.linalg.norm(x, axis=1, keepdims=True) if len(rows) else x

        i, j = threshold_pairs(unit(first), None if p == q else unit(second), cosine)
        ids = np.concatenate([first["id"], second["id"]]).astype(np.int64)
        size = np.concatenate([first["size"], second["size"]]).astype(np.int64)
        if p != q:
            j = j + len(first)
        links = np.bincount(i, size[j], len(ids)) + np.bincount(j, size[i], len(ids))
        on = links > 0
        return pd.DataFrame({"id": ids[on], "links": links[on].astype(np.int64), "low": _smallest(len(ids), i, j, ids)[on]})

    return run


def near_dedup(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of (vec_id, embedding, label).

    Rows are compared within a label only. A null label, and an embedding that is null, empty or
    zero or holds a null or non-finite component, links with nothing; vectors of different
    lengths never link. Each row counts as a vector, rows with one id too (they share a
    component); rows with a null id are one node after all others, not kept. Other columns are
    ignored.
    """
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    norm = F.aggregate(e, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    key = F.concat_ws("-", F.xxhash64("label", e), F.xxhash64(F.lit(17), "label", e))
    usable = F.coalesce(F.col("label").isNotNull() & e.isNotNull() & finite & (norm > 0), F.lit(False))
    rows = keep(vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(_NO_ID)).alias("id"), "label", e, F.when(usable, key).alias("key")), "vectors")
    total = rows.count()

    groups = keep(rows.where("key is not null").groupBy("key").agg(F.min("id").alias("rep"), F.count("*").alias("size")), "equal-vectors")
    own = hot_join(rows.select("id", "key"), groups, "key", "size", total)
    own = keep(own, "copies")
    reps = (rows.where("key is not null").join(groups, (rows.key == groups.key) & (rows.id == groups.rep), "left_semi").dropDuplicates(["key"])
            .join(groups, "key").select("label", F.size(e).alias("dim"), "id", e, "size"))
    sizes = reps.groupBy("label", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = reps.join(sizes, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int"))
    paired = (dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .select("label", "dim", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "block", "id", "embedding", "size"))
    linked = keep(paired.groupBy("label", "dim", "p", "q").applyInPandas(_block_pair(cosine), "id long, links long, low long"), "vector-links")

    counts = linked.groupBy("id").agg(F.sum("links").alias("links")).withColumnRenamed("id", "rep")
    edges = linked.select(F.col("id").alias("a"), F.col("low").alias("b")).unionByName(
        own.where("rep <> id").select(F.col("id").alias("a"), F.col("rep").alias("b")))
    comps = keep(components(edges, "vectors"), "vector-components")
    extra = counts.join(groups.select("rep", F.col("size").alias("n")), "rep")
    got = hot_join(own, extra, "rep", "n", total)
    out = got.join(comps, "id", "left")
    none = lambda c: F.when(c != _NO_ID, c)
    comp = F.coalesce("component", "id")
    return out.select(none(F.col("id")).alias("vec_id"), (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("size") - 1, F.lit(0))).cast("long").alias("n_links"),
                      none(comp).alias("component_id"), ((F.col("id") == comp) & (F.col("id") != _NO_ID)).alias("kept"))
