from __future__ import annotations

import hashlib
import itertools
import random
import re
import sys
import zlib
from functools import lru_cache

import numpy as np
import pytest

from contrail.llm import op12_repair as R
from tests.conftest import SF_SMALL

SCHEMA = "conv_id bigint, turn bigint, role string, text string, cost string, part int"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def brute(conv, rows):
    """Cheapest edits with the least letters, over every edit at every place."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        ink = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(maxsize=None)
    def best(i, at, inserted):
        ways = []
        if i == len(rows):
            if at in ("", "a"):
                ways.append((0, ""))
        else:
            f, initial = faults[i], rows[i][2][:1]
            ways.append((2, "D", *best(i + 1, at, 0)))
            if f not in ("blank", "duplicate"):
                more = 5 if f == "truncated" else 0
                if initial == NEXT[at] or (at == "" and initial == "s"):
                    ways.append((more, "K", *best(i + 1, initial, 0)))
                ways.append((1 + more, "R", *best(i + 1, NEXT[at], 0)))
        if inserted < 4:
            ways.append((5, "I", *best(i, NEXT[at], inserted + 1)))
        return min(((w[0] + w[2], w[1] + w[3]) if len(w) == 4 else w for w in ways), default=(1 << 30, ""))

    cost, audit = best(0, "", 0)
    at, said, i = "", [], 0
    for x in audit:
        if x == "I":
            at = NEXT[at]
            said.append({"u": "user", "a": "assistant"}[at] + ":")
            continue
        if x != "D":
            at = rows[i][2][0] if x == "K" else NEXT[at]
            said.append((rows[i][2] if x == "K" else {"u": "user", "a": "assistant"}[at]) + ":" + rows[i][3])
        i += 1
    turns = {r[1] for r in rows if r[1] is not None}
    initials = [r[2][:1] for r in rows]
    illegal = sum((a, b) not in {("s", "u"), ("u", "a"), ("a", "u")} for a, b in itertools.pairwise(initials))
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest())


def expected(rows):
    left = damage(rows)
    return sorted((brute(c, [r for r in left if r[0] == c]) for c in {r[0] for r in rows}), key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect()), key=str)


@pytest.mark.parametrize("sf_dir", [SF_SMALL, "/root/testdata/sf0.01"])
def test_conversations_against_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    want = expected([(r.conv_id, r.turn, r.role, r.text) for r in table.collect()])
    assert got(R.repair(R.damaged(table))) == want


def made(seed, n_convs, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "User", "u2", "", None]
    texts = ["Yes.", "No!", "cut off", "  ", "", None, "Why?\n", "a. b", "ünï.", "x" * 40 + "…"]
    rows = []
    for c in range(n_convs):
        for t in range(rng.randrange(longest)):
            turn = rng.choice([t, t, t, t, None, t // 2, t + 3])
            rows.append((c, turn, rng.choice(roles[:3] * 5 + roles), rng.choice(texts) if rng.random() < 0.6 else f"text {rng.random()}."))
    return rows


def test_odd_rows_against_brute_force(spark):
    rows = made(1, 60, 14) + [(None, 0, "user", "Hi."), (None, None, None, None), (None, 1, "assistant", "Bye."), (-7, 3, "user", "Q?"), (-7, 3, "user", "Q?"), (2**40, -5, "system", "S. " * 9000)]
    table = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)
    assert got(R.repair(R.damaged(table))) == expected(rows)


def test_a_long_conversation_is_cut_into_parts_and_pieces(spark):
    rows = [(5, t, r, x) for _, t, r, x in made(3, 1, 900)] + [(9, t, r, x) for _, t, r, x in made(4, 1, 300)] + made(5, 4, 6)
    table = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)
    sys.setrecursionlimit(20_000)
    assert got(R.repair(R.damaged(table), parts=6)) == expected(rows)


def test_pieces_of_a_conversation():
    """Any cut of the turns into pieces gives the same costs and edits as one piece."""
    t, rng = R.tables(), np.random.default_rng(5)
    for _ in range(200):
        s = rng.integers(0, 9, rng.integers(0, 40))
        whole, state = t.trace(s, 0, 0)
        cut = int(rng.integers(0, len(s) + 1))
        middle, total = (x[0] for x in t.back_all(s[cut:]))
        left, between = t.trace(s[:cut], 0, int(middle))
        right, end = t.trace(s[cut:], between, 0)
        assert (left + right, end) == (whole, state)
        assert t.back(s, 0)[:2] == (t.back(s[:cut], int(middle))[0], t.back(s[:cut], int(middle))[1] + int(total))


def test_block_lookup_equals_single_steps():
    t = R.Tables(block=3)
    one = R.Tables(block=1)
    assert t.vectors == one.vectors and len(t.vectors) < 256
    s = np.random.default_rng(1).integers(0, 9, 50)
    assert [x.tolist() for x in t.back_all(s)] == [x.tolist() for x in one.back_all(s)]


def test_empty_table(spark):
    assert R.repair(R.damaged(spark.createDataFrame([], SCHEMA))).count() == 0
    assert R.repair(R.plain(spark.createDataFrame([(1, 0, "user", "Hi.", "", 0), (1, 1, "assistant", "Ho.", "", 0)], SCHEMA))).first().audit == "KK"
