from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from contrail.llm import op1_elias_fano as lm
from contrail.llm.queries import op1_lm_score
from tests.llm.helpers import no_docs, odd_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows, held, mu1=lm.MU1, b2=lm.B2):
    """Plain dictionaries; every frequent or rare context is its own class (few words: no pooling clash assumed)."""
    texts = [(i, [*WORD.findall(lower(t or "")), "\n"]) for i, t in rows]
    n1 = Counter(w for (i, ts) in texts if not held(i) for w in ts)
    n, v = sum(n1.values()), len(n1)
    hashes = {w: (lm.END if w == "\n" else lm.W.split(lm.pa.array([w])).hash[0]) for i, ts in texts for w in ts}
    often = sorted([w for w in n1 if n1[w] * lm.CLASSES >= n], key=lambda w: (-n1[w], int(np.array(hashes[w]).view(np.int64))))
    f = lm.Frequent(np.array([hashes[w] for w in often], np.uint64), np.array([n1[w] for w in often]), n, v, 1)
    cls = dict(zip(hashes, f.classes(np.array(list(hashes.values()), np.uint64)).tolist()))
    c2, c3, x1, x2 = Counter(), Counter(), Counter(), Counter()
    steps = {}
    for i, ts in texts:
        a = b = lm.START
        steps.setdefault(i, [])
        for w in ts:
            steps[i].append((a, b, w))
            if not held(i):
                c2[b, w] += 1
                c3[a, b, w] += 1
                x1[b] += 1
                x2[a, b] += 1
            a, b = b, cls[w]
    z = n + 0.1 * (v + 1)
    b1 = mu1 / z
    out = {}
    for i, s in steps.items():
        base = sum(math.log10((n1[w] + 0.1) / z) for *_, w in s)
        score = sum(math.log10((c3[a, b, w] + b2 * (c2[b, w] + b1 * (n1[w] + 0.1))) / (x2[a, b] + b2 * (x1[b] + b1 * z))) for a, b, w in s)
        out[i] = (len(s), sum(n1[w] > 0 for *_, w in s), n, base, score)
    return out


def check(got, want):
    assert {r.doc_id for r in got} == set(want)
    for r in got:
        tokens, known, n, base, score = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9)
        assert r.score == pytest.approx(score, rel=1e-4, abs=0.0006 * tokens)


def test_elias_fano():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 0), (1, 5), (1000, 10), (5000, 1 << 40), (70_000, 70_000)):
        x = np.sort(rng.integers(0, top + 1, n))
        e = lm.EliasFano(x)
        at = rng.permutation(n)
        assert (e.get(at) == x[at]).all()


def test_find_is_exact():
    keys = np.array([0 << 16 | 3, 0 << 16 | 9, 2 << 16 | 1, 2 << 16 | 65535], np.int64)
    level = lm.Level(3, keys, np.zeros(4))
    assert level.find(np.array([0, 0, 1, 2, 2, -1]), np.array([3, 4, 3, 65535, 2, 1])).tolist() == [0, -1, -1, 3, -1, -1]


@pytest.mark.parametrize("shard_bytes", [lm.SHARD_BYTES, 40_000])
def test_query_against_brute_force(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(lm, "SHARD_BYTES", shard_bytes)  # more shards, hot words spread
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op1_lm_score(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in got)
    check(got, brute(rows, lambda i: zlib.crc32(str(i).encode()) % 10 == 0))
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_probabilities_sum_to_one(spark):
    """Over all known words and one unknown, after any context."""
    train = [(i, "a b c a b d " * 3 + x) for i, x in enumerate(["", "e", "a c b"])]
    vocab = ["a", "b", "c", "d", "e", "zzz"]
    for context in ("", "a", "a b", "q a", "d q"):
        rows = train + [(100 + k, f"{context} {w}") for k, w in enumerate(vocab)] + [(200, context)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = {r.doc_id: r for r in lm.score(docs, F.col("doc_id") >= 100, mu1=5.0, b2=0.3).collect()}
        want = brute(rows, lambda i: i >= 100, 5.0, 0.3)
        check(got.values(), want)


def test_odd_rows(spark):
    docs = odd_docs(spark)
    got = lm.score(docs, F.col("doc_id") == 5).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()], lambda i: i == 5)
    check(got, want)
    assert lm.score(no_docs(spark), F.lit(False)).count() == 0
    only_held = lm.score(docs, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in only_held)


def test_sums_are_merged_in_pieces():
    rng = np.random.default_rng(5)
    parts = [[rng.integers(-50, 50, n).astype(np.int64).view(np.uint64), rng.integers(0, 9, n).astype(np.uint32), rng.integers(0, 9, n).astype(np.uint32),
              rng.normal(size=n), rng.normal(size=n).astype(np.float32)] for n in (0, 1, 40, 300, 7)]
    for most in (0, 50, 10_000):
        ids, sums = lm.add_up(iter(parts), most)
        want = {}
        for p in parts:
            for i, *rest in zip(p[0].view(np.int64), *p[1:]):
                want[int(i)] = [a + float(b) for a, b in zip(want.get(int(i), [0.0] * 4), rest)]
        assert ids.tolist() == sorted(want)
        np.testing.assert_allclose(sums.T, [want[i] for i in sorted(want)])
    assert len(lm.add_up(iter([]))[0]) == 0
