from __future__ import annotations

import numpy as np
import pytest

from contrail.llm import op10_cover_tree as C
from contrail.llm.queries import op10_embedding_dedup

SCHEMA = "vec_id bigint, embedding array<float>, label int, rep string, size int"


def brute(rows, cosine=C.COSINE):
    key = [C._NO_ID if r[0] is None else r[0] for r in rows]
    parent = {k: k for k in key}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if a[2] is None or a[2] != b[2] or not a[1] or not b[1] or len(a[1]) != len(b[1]) or None in a[1] or None in b[1]:
                continue
            x, y = np.float64(np.float32(a[1])), np.float64(np.float32(b[1]))
            if not (np.isfinite(x).all() and np.isfinite(y).all() and x.any() and y.any()):
                continue
            if (x @ y) / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                links[i] += 1
                links[j] += 1
                p, q = find(key[i]), find(key[j])
                parent[max(p, q)] = min(p, q)
    none = lambda x: None if x == C._NO_ID else x
    return sorted([(none(k), n, none(find(k)), k != C._NO_ID and find(k) == k) for k, n in zip(key, links)], key=str)


def run(df, **kw):
    return sorted([tuple(r) for r in C.near_dedup(df, **kw).select("vec_id", "n_links", "component_id", "kept").collect()], key=str)


@pytest.mark.parametrize("shape", [(300, 3), (300, 64), (40, 2)])
@pytest.mark.parametrize("cosine", [0.93, 0.5])
def test_dual_traversal_is_exact(shape, cosine):
    rng = np.random.default_rng(4)
    x = rng.normal(size=shape)
    x = np.vstack([x, x[:30] + 0.05 * rng.normal(size=(30, shape[1])), x[:5]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = C.threshold_pairs(x, None, cosine)
    assert sorted(zip(i.tolist(), j.tolist())) == [(a, b) for a in range(len(x)) for b in range(a + 1, len(x)) if x[a] @ x[b] >= cosine]
    i, j = C.threshold_pairs(x[:200], x[100:], cosine)
    assert sorted(zip(i.tolist(), j.tolist())) == [(a, b) for a in range(len(x[:200])) for b in range(len(x) - 100) if x[a] @ x[100 + b] >= cosine]


def test_cover_tree_covers_and_nests():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    seen = []

    def walk(node):
        if not node.children:
            seen.append(node.centre)
            return [node.centre]
        below = [i for c in node.children for i in walk(c)]
        assert node.centre in below and np.linalg.norm(x[below] - x[node.centre], axis=1).max() <= node.radius + 1e-7
        return below

    walk(C.cover_tree(x))
    assert sorted(seen) == list(range(200))


@pytest.mark.parametrize("block", [C.BLOCK, 15])
def test_query_table_against_brute_force(spark, block):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert run(df, block=block) == brute([tuple(r) for r in df.select("vec_id", "embedding", "label").collect()])
    assert op10_embedding_dedup(spark, "/root/testdata/sf0.01").count() == df.count()


def test_odd_rows(spark):
    rng = np.random.default_rng(8)
    base = [float(v) for v in np.float32(rng.normal(size=6))]
    near = [v + 0.01 for v in base]
    rows = [(1, base, 1, "a", 1), (2, base, 1, None, None), (3, near, 1, "a", 1), (4, base, 2, "a", 1), (5, base, None, "a", 1), (6, None, 1, "a", 1),
            (7, [0.0] * 6, 1, "a", 1), (8, [*base[:5], None], 1, "a", 1), (9, [*base[:5], float("nan")], 1, "a", 1), (10, [*base[:5], float("inf")], 1, "a", 1),
            (11, base[:5], 1, "a", 1), (12, [], 1, "a", 1), (None, near, 1, "a", 1), (None, [v * 2 for v in base], 2, "a", 1), (14, base, 1, "a", 1), (14, base, 1, "a", 1),
            (15, [v * 3 for v in near], 1, "a", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert run(df) == brute([r[:3] for r in rows])
    assert run(spark.createDataFrame([], SCHEMA)) == []
