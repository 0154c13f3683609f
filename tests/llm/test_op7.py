from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from contrail.llm import op7_skip_join as J
from tests.llm.helpers import no_docs, odd_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=J.WORDS):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, percent=J.PERCENT):
    sets = [shingles(t) for _, t in rows]
    key = [J._NO_ID if i is None else i for i, _ in rows]
    parent = {i: i for i in key}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for k, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)
    for p in {p for g in where.values() for p in combinations(g, 2)}:
        a, b = sets[p[0]], sets[p[1]]
        if 100 * len(a & b) >= percent * len(a | b):
            x, y = find(key[p[0]]), find(key[p[1]])
            parent[max(x, y)] = min(x, y)
    none = lambda x: None if x == J._NO_ID else x
    return sorted([(none(i), len(s), none(find(i))) for i, s in zip(key, sets)], key=str)


def run(docs):
    return sorted([tuple(r) for r in J.classes(docs).select("doc_id", "n_shingles", "component_id").collect()], key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_documents_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def near_copies(seed, n=60):
    rng = random.Random(seed)
    out = []
    for g in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([5, 9, 30, 80, 200]))]
        for k in range(n // 6):
            t = list(base)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(len(t))] = f"x{rng.randrange(9)}"
            out.append((1000 + len(out), " ".join(t) + (" shared tail of many texts here" if k % 3 == 0 else ""), "en", "s", 1, 0, "", 0))
    return out


@pytest.mark.parametrize(("seed", "hashes"), [(1, 1), (2, J.MIN_HASHES)])
def test_links_that_minimum_hashes_miss_come_from_the_index(spark, monkeypatch, seed, hashes):
    monkeypatch.setattr(J, "MIN_HASHES", hashes)
    docs = odd_docs(spark, near_copies(seed, 120))
    assert run(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_candidates_lose_no_similar_pair_and_skip_classes():
    rng = random.Random(5)
    sets = [set(rng.sample(range(60), rng.randrange(5, 40))) for _ in range(80)]
    sets += [s - {next(iter(s))} for s in sets[:40]] + [s | {100 + i} for i, s in enumerate(sets[:40])]
    rows = []
    for i, s in enumerate(sets):
        order = sorted(s, key=lambda x: (x * 37) % 61)
        for p in range(len(s) - -(-len(s) * J.PERCENT // 100) + 1):
            rows.append((order[p], i, len(s), p, i))
    cols = [np.array(c) for c in zip(*rows)]
    a, b = J.candidates(*cols, J.PERCENT)
    got = set(zip(a.tolist(), b.tolist()))
    want = {(i, j) for i, j in combinations(range(len(sets)), 2) if 100 * len(sets[i] & sets[j]) >= J.PERCENT * len(sets[i] | sets[j])}
    assert want <= got
    assert not len(J.candidates(*cols[:4], np.zeros(len(rows)), J.PERCENT)[0])


def test_parity_maps_differ_no_more_than_the_sets():
    rng = np.random.default_rng(7)
    sets = [rng.integers(0, 1 << 60, n).astype(np.uint64) for n in (3, 40, 200, 700)] + [np.zeros(0, np.uint64)]
    sets += [np.concatenate([s[: len(s) - 2], rng.integers(0, 1 << 60, 5).astype(np.uint64)]) for s in sets]
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    maps = J.parities(row, np.concatenate(sets), np.array([len(s) for s in sets]))
    for i, j in combinations(range(len(sets)), 2):
        assert J.differing(maps[i], maps[j]) <= len(set(sets[i].tolist()) ^ set(sets[j].tolist()))


def test_empty_table(spark):
    assert run(no_docs(spark)) == []
