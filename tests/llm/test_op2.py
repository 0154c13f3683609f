from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import op2_mix as M
from contrail.llm.queries import op2_mix_sources
from tests.llm.helpers import no_docs, odd_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(cells, targets, rounds=400):
    w = {c: t / sum(cells.values()) for c, t in cells.items() if t}
    for _ in range(rounds):
        for k, target in enumerate(targets):
            there = {c[k] for c in w}
            scale = sum(target[x] for x in there)
            sums = defaultdict(float)
            for c, v in w.items():
                sums[c[k]] += v
            w = {c: v * target[c[k]] / scale / sums[c[k]] for c, v in w.items()}
    return w


def power(cells, k):
    sums = defaultdict(float)
    for c, t in cells.items():
        sums[c[k]] += t
    up = {x: t**M.FLATTEN for x, t in sums.items() if t}
    return {x: v / sum(up.values()) for x, v in up.items()}


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    got = op2_mix_sources(spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(got) == len(docs)
    cells = defaultdict(int)
    for r in got:
        assert r.n_tokens == len(WORD.findall(docs[r.doc_id].text or ""))
        cells[r.source, r.lang, r.topic] += r.n_tokens
    w = brute(cells, [power(cells, k) for k in range(3)])
    total = sum(cells.values())
    for r in got:
        if r.n_tokens:
            assert r.weight == pytest.approx(w[r.source, r.lang, r.topic] / cells[r.source, r.lang, r.topic] * total, rel=1e-4)
    assert sum(r.n_tokens * r.prob for r in got) == pytest.approx(M.BUDGET * total, rel=1e-4)
    kept = sum(r.n_tokens for r in got if r.kept)
    assert abs(kept / total - M.BUDGET) < 0.06
    for k, m in enumerate(M.MARGINS):  # weighted tokens meet the marginals
        for x, share in power(cells, k).items():
            assert sum(r.n_tokens * r.weight for r in got if r[m] == x) / total == pytest.approx(share, rel=1e-3)


def test_given_targets_and_absent_categories(spark):
    rows = [(i, "a b c d", "en" if i % 3 else "fr", f"s{i % 4}", 7) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    targets = {"source": spark.createDataFrame([(f"s{i}", 0.2) for i in range(5)], "source string, share double"),
               "lang": spark.createDataFrame([("en", 0.5), ("fr", 0.5)], "lang string, share double")}
    got = M.mix(docs, targets, budget=0.4)
    by = {r.lang: r.t for r in got.groupBy("lang").agg(F.sum(F.col("_prob") * F.col("_tokens")).alias("t")).collect()}
    assert by["en"] == pytest.approx(480, rel=1e-3) and by["fr"] == pytest.approx(480, rel=1e-3)


def test_calibration_with_full_cells(spark):
    cells = spark.createDataFrame([("a", 100, 0.9), ("b", 900, 0.1)], "source string, tokens long, weight double")
    rate = M.calibrate(cells, 0.3)
    assert 100 * min(1, rate * 0.009) + 900 * min(1, rate * 0.1 / 900) == pytest.approx(300, rel=1e-6)
    assert M.calibrate(cells, 1.0) == float("inf")


def test_odd_rows_and_fixed_draws(spark):
    docs = odd_docs(spark).withColumn("_prob", F.lit("clash"))
    got = M.mix(docs)
    rows = got.collect()
    assert len(rows) == docs.count() and all(r._kept for r in rows if not r._tokens)
    assert [c for c in docs.columns if c != "_prob"] == [c for c in got.columns if not c.startswith("_")]
    again = {str(r) for r in M.mix(docs.repartition(3)).collect()}
    assert {r.doc_id: r._kept for r in rows} == {r.doc_id: r._kept for r in M.mix(docs.repartition(3)).collect()} and again
    assert M.mix(no_docs(spark)).count() == 0


def test_topics(spark):
    texts = ["", None, "a | b", "x###", "All rights reserved.", "m@x", "word", "w" * 900, "w" * 6000]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1).sort("i").select(M.topic_of(F.col("t"))).collect()]
    assert got == ["empty", "empty", "table", "symbols", "legal", "contact", "short", "prose", "long"]
    assert np.unique(got).size == 8
