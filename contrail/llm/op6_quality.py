"""Quality classifier: histogram gradient-boosted trees over statistics of a text.

Statistics are computed from the bytes and word hashes of whole Arrow batches. Trees are grown
on histograms of binned statistics of a bounded sample of labelled rows, then flattened: each
tree is a full binary tree of fixed depth in arrays (feature, cut, leaf), and scoring walks all
rows of a batch through all trees with numpy, one indexing step a level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm import words as W
from contrail.llm.common import fold, mix64

#: Most labelled rows that the trees are fitted on (by a hash of the id, so the same rows each run).
SAMPLE = 20_000
TREES, DEPTH, BINS, RATE, L2, LEAST = 80, 4, 64, 0.15, 1.0, 5.0

FEATURES = ("log_bytes", "log_words", "letters", "digits", "upper", "spaces", "stops", "commas", "symbols", "pipes", "quotes", "wide",
            "word_mean", "word_sd", "word_max", "short_words", "long_words", "distinct", "top_word", "same_as_last", "distinct_pairs",
            "log_lines", "line_mean", "same_lines", "stops_a_word")

_KIND = np.zeros((9, 256), dtype=np.int64)
for _k, _set in enumerate((b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" \t\n\r\x0b\x0c",
                           b".!?", b",;:", b"#$%&*+<=>@[\\]^_`{}~/", b"|", b"\"'()-")):
    _KIND[_k, list(_set)] = 1


def statistics(column: pa.Array) -> np.ndarray:
    """One row a text, one column a statistic of FEATURES, all finite; texts without words have zeros there."""
    n = len(column)
    out = np.zeros((n, len(FEATURES)))
    if not n:
        return out
    data, at = W.utf8(column)
    lo = int(at[0])
    b = data[lo : int(at[-1])]
    size = np.diff(at)
    per = np.maximum(size, 1)
    sums = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[at - lo])
    out[:, 0] = np.log1p(size)
    for k in range(9):
        out[:, 2 + k] = sums(_KIND[k][b]) / per
    out[:, 11] = sums((b >= 128).astype(np.int64)) / per
    lines = sums((b == 10).astype(np.int64)) + 1
    out[:, 21], out[:, 22] = np.log1p(lines), size / lines

    w = W.split(column)
    row, h = w.row, w.hash
    count = np.bincount(row, minlength=n)
    many = np.maximum(count, 1)
    out[:, 1] = np.log1p(count)
    if not len(row):
        return out
    length = (w.end - w.start).astype(float)
    mean = np.bincount(row, length, n) / many
    out[:, 12] = mean
    out[:, 13] = np.sqrt(np.maximum(np.bincount(row, length**2, n) / many - mean**2, 0))
    np.maximum.at(out[:, 14], row, np.log1p(length))
    out[:, 15] = np.bincount(row, length <= 2, n) / many
    out[:, 16] = np.bincount(row, length >= 12, n) / many
    _, where, times = np.unique(mix64(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True, return_counts=True)
    out[:, 17] = np.bincount(row[where], minlength=n) / many
    top = np.zeros(n)
    np.maximum.at(top, row[where], times)
    out[:, 18] = top / many
    same = row[1:] == row[:-1]
    out[:, 19] = np.bincount(row[1:][same], h[1:][same] == h[:-1][same], n) / many
    pairs = mix64(h[1:][same] + mix64(h[:-1][same] + row[1:][same].astype(np.uint64)))
    _, where = np.unique(pairs, return_index=True)
    out[:, 20] = np.bincount(row[1:][same][where], minlength=n) / many
    # lines by the sum of their placed word hashes
    line = np.concatenate([[0], np.cumsum(b == 10)])[w.start - lo]
    first = np.flatnonzero(np.diff(line, prepend=-1).astype(bool) | np.diff(row, prepend=-1).astype(bool))
    place = np.arange(len(h)) - np.repeat(first, np.diff(first, append=len(h)))
    run = np.concatenate([[np.uint64(0)], np.cumsum(mix64(h + place.astype(np.uint64)))])
    key = mix64(run[np.append(first[1:], len(h))] - run[first] + mix64(row[first].astype(np.uint64)))
    _, where = np.unique(key, return_index=True)
    full = np.maximum(np.bincount(row[first], minlength=n), 1)
    out[:, 23] = 1 - np.bincount(row[first][where], minlength=n) / full
    out[:, 24] = out[:, 6] * per / many
    return out


@dataclass
class Trees:
    """Flattened trees: node i of a tree has the children 2i + 1 and 2i + 2."""

    feature: np.ndarray  # (trees, 2^depth - 1)
    cut: np.ndarray
    leaf: np.ndarray  # (trees, 2^depth)
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            while inner and node[:1].size and node[0] < inner:
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            total += leaf[node - inner]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE) -> Trees:
    """Boost on the logistic loss; with one class or no rows the score is a smoothed share."""
    n, width = x.shape
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    inner = 2**depth - 1
    if not n or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) for k in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    flat = binned + np.arange(width) * bins
    margin = np.full(n, base)
    features, points, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        f, c = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            start, size = 2**level - 1, 2**level
            at = ((node - start)[:, None] * (width * bins) + flat).ravel()
            shape = (size, width, bins)
            hg = np.bincount(at, np.repeat(g, width), size * width * bins).reshape(shape).cumsum(axis=2)
            hh = np.bincount(at, np.repeat(h, width), size * width * bins).reshape(shape).cumsum(axis=2)
            gt, ht = hg[:, :, -1:], hh[:, :, -1:]
            gain = hg**2 / (hh + L2) + (gt - hg) ** 2 / (ht - hh + L2) - gt**2 / (ht + L2)
            gain[(hh < LEAST * 0.1) | (ht - hh < LEAST * 0.1)] = 0
            best = gain.reshape(size, -1).argmax(axis=1)
            for k, i in enumerate(best):
                col, b = divmod(int(i), bins)
                if gain[k, col, b] > 1e-9 and b < len(cuts[col]):
                    f[start + k], c[start + k] = col, cuts[col][b]
            node = 2 * node + 1 + (x[np.arange(n), f[node]] > c[node])
        g_sum, h_sum = np.bincount(node - inner, g, inner + 1), np.bincount(node - inner, h, inner + 1)
        leaf = -rate * g_sum / (h_sum + L2)
        margin = margin + leaf[node - inner]
        features.append(f)
        points.append(c)
        leaves.append(leaf)
    return Trees(np.array(features), np.array(points), np.array(leaves), base)


def train_ids(labels: DataFrame, label_col: str, use: Column, sample: int = SAMPLE) -> DataFrame:
    """doc_id and y of at most ``sample`` labelled rows, chosen by a hash of the id; an id with several labels has the largest."""
    return (labels.where(use & F.col("doc_id").isNotNull() & F.col(label_col).isNotNull()).groupBy("doc_id")
            .agg(F.max(label_col).cast("double").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))


def train(docs: DataFrame, labels: DataFrame, label_col: str, use: Column, sample: int = SAMPLE) -> Trees:
    """Trees fitted on the statistics of the sampled rows; ``use`` picks the labels that may be learned from."""
    rows = docs.select("doc_id", "text").join(F.broadcast(train_ids(labels, label_col, use, sample)), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch):
                x = statistics(block.column("text"))
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), block.column("y"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    got = rows.mapInArrow(run, "doc_id long, y double, x array<double>").sort("doc_id", "x").toPandas()  # at most the sampled rows
    return fit(np.array(got["x"].tolist()).reshape(-1, len(FEATURES)), got["y"].to_numpy(float))


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of each row; null counts as empty, which has a score like any text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch):
                yield pa.RecordBatch.from_arrays([block.column("doc_id"), pa.array(shared.value.score(statistics(block.column("text"))))], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    return fold(doc_id, 4) == 2
