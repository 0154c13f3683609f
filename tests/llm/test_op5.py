from __future__ import annotations

import re
from collections import defaultdict

import pytest

from contrail.llm import op5_templates as T
from contrail.llm.op5_templates import drop_recurring_lines
from tests.llm.helpers import no_docs, odd_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def templates(line):
    tokens = ["<*>" if re.search("[0-9]", t) else "".join(c.lower() if c.isascii() else c for c in t) for t in WORD.findall(line)]
    n = len(tokens)
    if n < T.MIN_TOKENS:
        return []
    rest = tokens[T.LEADING:]
    out = [(n, tuple(tokens))]
    if n >= T.GENERAL:
        for j in range(T.PARTS):
            a, z = j * len(rest) // T.PARTS, (j + 1) * len(rest) // T.PARTS
            out.append((n, (*tokens[: T.LEADING], *rest[:a], f"field {j}", *rest[z:])))
    return out


def brute(rows, min_docs=T.MIN_DOCS):
    docs, first = defaultdict(int), {}
    for i, t in rows:
        for k in {k for x in (t or "").split("\n") for k in templates(x)}:
            docs[k] += 1
            first[k] = min(first.get(k, T._NO_ID), T._NO_ID if i is None else i)
    out = []
    for i, t in rows:
        me = T._NO_ID if i is None else i
        kept = [x for x in (t or "").split("\n") if not any(docs[k] >= min_docs and first[k] != me for k in templates(x))]
        n = len((t or "").split("\n")) - len(kept)
        out.append((i, t if not n else "\n".join(kept), n))
    return sorted(out, key=str)


def run(docs):
    return sorted([(r.doc_id, r.text, r.n_dropped) for r in drop_recurring_lines(docs).collect()], key=str)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_documents_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert run(docs) == want and any(n for *_, n in want)


def test_variable_fields_and_odd_rows(spark):
    line = "user {} logged in from host {} after {} tries today"
    extra = [(50 + i, f"own text {'abcd'[i]} stays\n" + line.format("bob", f"10.0.0.{i}", i), "en", "s", 1, 0, "", 0) for i in range(4)]
    extra += [(60 + i, "request for the page took some time on node " + "abcdef"[i], "en", "s", 1, 0, "", 0) for i in range(4)]
    extra += [(70 + i, "same line in a repeated row\nsame line in a repeated row", "en", "s", 1, 0, "", 0) for i in (0, 0, 0, 1)]
    docs = odd_docs(spark, extra)
    got = run(docs)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    by = {i: (t, n) for i, t, n in got}
    assert by[50][1] == 0 and all(by[50 + i] == (f"own text {'abcd'[i]} stays", 1) for i in (1, 2, 3))
    assert by[60][1] == 0 and all(by[60 + i] == ("", 1) for i in (1, 2, 3))
    assert drop_recurring_lines(docs).columns == [*docs.columns, "n_dropped"]
    assert drop_recurring_lines(no_docs(spark)).count() == 0


def test_rows_of_numbers_recur_only_as_they_stand(spark):
    rows = ["{}.5 2{} 17", "2024-01-0{} 12:0{}:00 21.{}", "{} x{} 4 total", "station {}7 4 5{} 9"]
    extra = [(80 + i, "\n".join(r.format(i, i, i) for r in rows) + "\n1 2 3\n2024-01-0%d 12:00:0%d server started and is ready again" % (i, i), "en", "s", 1, 0, "", 0) for i in range(1, 5)]
    by = {i: (t, n) for i, t, n in run(odd_docs(spark, extra))}
    assert by[81][1] == 0
    # unlike rows stay; the same row of numbers and the template of the log line go
    assert all(by[80 + i] == ("\n".join(r.format(i, i, i) for r in rows), 2) for i in (2, 3, 4))


def test_counting_and_testing_lines_hold_a_bounded_part_of_the_text():
    import tracemalloc
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    line = " ".join(f"word{i} steady plain" for i in range(30)) + "\n"
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(160)), "row_key": pa.array(range(160)), "text": [line * 100] * 160})
    assert batch.nbytes > 8 << 20
    none = SimpleNamespace(value=SimpleNamespace(hit=lambda keys: np.zeros(len(keys), bool)))
    for step in (T._count, T._hits(none)):
        list(step([batch.slice(0, 2)]))  # tables that are made once
        tracemalloc.start()
        list(step([batch]))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 120 << 20
