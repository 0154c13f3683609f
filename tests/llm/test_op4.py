from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from contrail.llm.common import KeyFilter, components, hot_join, key_filter
from contrail.llm.op4_bloom import exact_dedup
from tests.llm.helpers import no_docs, odd_docs


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    out = []
    for i, t in rows:
        g = groups[t or ""]
        top = max((x for x in g if x is not None), default=None)
        out.append((i, top, len(g), i == top, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    extra = [(100 + i, f"text {i % 7}" if i % 3 else "hot", "en", "s", 1, 0, "", 0) for i in range(400)]
    docs = odd_docs(spark, extra)
    got = sorted([tuple(r) for r in exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_empty_table(spark):
    assert exact_dedup(no_docs(spark)).count() == 0


def test_filter_has_no_misses_and_full_filter_only_lets_more_through(spark):
    df = spark.range(4000).select((F.col("id") % 3000).alias("h"))
    f = key_filter(df, "h", 4000, repeated=True)
    assert f.hit(np.arange(1000)).all() and not f.hit(np.arange(1000, 3000)).all()
    assert KeyFilter(np.full(8192, 255, np.uint8), 1 << 16).hit(np.arange(50)).all()


def test_hot_join_is_a_left_join(spark):
    rows = spark.createDataFrame([("a", i) for i in range(90)] + [("b", 1), ("c", 2), (None, 3)], "k string, i int")
    groups = rows.where("k <> 'c'").groupBy("k").agg(F.count("*").alias("n"))
    got = hot_join(rows, groups, "k", "n", 93, parts=3)
    assert got.groupBy("k").agg(F.max("n").alias("n"), F.count("*").alias("c")).sort("k").collect() == [
        (None, None, 1), ("a", 90, 90), ("b", 1, 1), ("c", None, 1)]


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (120, 2))] + [(i, i + 1) for i in range(300, 360)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for a, b in edges for x in (a, b) if a != b}
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long"), "t").count() == 0
