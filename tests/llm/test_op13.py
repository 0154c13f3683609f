from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from contrail.llm import op13_prefix_trie as P
from tests.conftest import SF_SMALL

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth string, part int"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    made = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = own.get(base, [])[:h] + v[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] += not kids[node]
        saved[node] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        if node:
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), kids[node], leaves[node], saved[node],
                   hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()) for node, m in members.items())


def got(df):
    return sorted(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def made(seed, n_convs, longest, texts):
    rng, rows = random.Random(seed), []
    for c in range(n_convs):
        for t in range(rng.randrange(1, longest)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"{rng.randrange(texts)}é"))
    return rows


@pytest.mark.parametrize("sf_dir", [SF_SMALL, "/root/testdata/sf0.01"])
def test_conversations_against_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    assert got(P.trie(table)) == brute([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])


@pytest.mark.parametrize(("segment", "shard"), [(256, 10**6), (256, 40), (4, 10**6), (3, 25), (1, 30)])
def test_any_segments_and_shards(spark, segment, shard):
    rows = made(7, 80, 12, 2)
    rows += [(100 + 5 * i, t, "user", "copy") for i in range(30) for t in range(11)]  # equal conversations
    rows += [(300, None, None, None), (300, 0, "a", None), (300, 0, "a", None), (301, 5, "", "x"), (-7, 1, "u", "0é"), (-5, 1, "u", "1é"), (None, 0, "user", "lost"), (2**40, 0, "user", "1é" * 9000)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert got(P.trie(table, segment, shard)) == brute(rows)


def test_long_conversation(spark):
    rows = [(c, t, "user", f"{t % 3}") for c in (10, 11, 20) for t in range(700)] + [(11, 700, "user", "more"), (20, 300, "user", "other")]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    assert got(P.trie(table, shard=500)) == brute(rows)


def test_tree_and_medians():
    assert sorted(P.medians(37)) == list(range(37)) and next(P.medians(37)) == 18
    tree = P.Tree()
    for i in P.medians(1023):
        tree.insert([i], [1], 1, i)
    depth = {0: 0}
    for node in range(1, 1024):
        for side in (tree.low, tree.high):
            if side[node]:
                depth[side[node]] = depth.get(node, 0) + 1
    assert max(depth.values()) == 9  # balanced


def test_empty_table(spark):
    assert P.trie(spark.createDataFrame([], SCHEMA)).count() == 0
