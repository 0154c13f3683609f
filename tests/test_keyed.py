"""Keyed state of a stream: bounded, one row a key, late and repeated batches."""

from __future__ import annotations

import random
import uuid

from contrail.session import scratch_path
from contrail.streaming.keyed import KeyedState, latest_row

FOLD = latest_row(["k"], ["ts", "id"], ["v"], ["n"])
SCHEMA = "k string, ts long, id long, v string, n long"


def state(spark, every):
    return KeyedState(spark, scratch_path(spark, f"t/keyed-{uuid.uuid4().hex}"), FOLD, every)


def expected(batches):
    out = {}
    for r in (r for b in batches for r in b):
        best, n = out.get(r[0], (None, 0))
        key = (-1 if r[1] is None else r[1], r[2], r[3])
        out[r[0]] = (key if best is None or key > best else best, n + r[4])
    return sorted((k, None if b[0] == -1 else b[0], b[1], b[2], n) for k, (b, n) in out.items())


def test_state_levels_off_and_late_rows_count_but_never_replace(spark):
    s, rng = state(spark, 3), random.Random(3)
    batches, sizes = [], []
    for b in range(8):
        rows = [(rng.choice("abcd"), rng.choice([None, *range(20)]), 10 * b + i, rng.choice("xyz"), 1) for i in range(10)]
        batches.append(rows)
        for _ in range(2 if b in (2, 3, 4, 6) else 1):  # a batch that is run again replaces itself
            s.absorb(spark.createDataFrame(rows, SCHEMA), b)
        got = sorted(tuple(r) for r in s.read().collect())
        assert got == expected(batches)
        sizes.append(s.stored().count())
    assert s.covered() == 6
    assert max(sizes) <= 4 * (3 + 1) and sizes[7] <= sizes[5]


def test_before_the_first_batch_and_empty_batches(spark):
    s = state(spark, 2)
    assert s.read() is None
    for b in range(5):
        s.absorb(spark.createDataFrame([], SCHEMA), b)
        assert s.read().count() == 0
    s.absorb(spark.createDataFrame([("a", 1, 1, None, 2)], SCHEMA), 5)
    assert [tuple(r) for r in s.read().collect()] == [("a", 1, 1, None, 2)]


def test_a_compaction_that_was_cut_is_repeated(spark, monkeypatch):
    s = state(spark, 2)
    for b in range(2):
        s.absorb(spark.createDataFrame([("a", b, b, "x", 1)], SCHEMA), b)
    commit = s.snapshots.commit

    def cut(rows, version):
        rows.write.mode("overwrite").parquet(f"{s.snapshots.data}/version={version}")
        raise RuntimeError("cut")
    monkeypatch.setattr(s.snapshots, "commit", cut)
    rows = spark.createDataFrame([("a", 0, 9, "late", 1)], SCHEMA)
    try:
        s.absorb(rows, 2)
    except RuntimeError:
        pass
    assert s.covered() == 0 and [tuple(r) for r in s.read().collect()] == [("a", 1, 1, "x", 2)]
    monkeypatch.setattr(s.snapshots, "commit", commit)
    s.absorb(rows, 2)
    assert s.covered() == 2 and [tuple(r) for r in s.read().collect()] == [("a", 1, 1, "x", 3)]
