from __future__ import annotations

import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.llm import op3_pii as P
from contrail.llm.queries import op3_pii_spans
from tests.llm.helpers import no_docs, odd_docs

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(sum(divmod(int(x) * 2, 10)) if i % 2 else int(x) for i, x in enumerate(reversed(d))) % 10 == 0


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.split(".")), "card": lambda: 14 <= len(d) <= 19 and luhn(d), "phone": lambda: 10 <= len(d) <= 15}[kind]()


def brute(text):
    spans = sorted((m.start(), k, m.end()) for k, kind in enumerate(P.KINDS) for m in re.finditer(PATTERNS[kind], text or "") if passes(kind, m.group()))
    return [f"{P.KINDS[k]}:{s}:{e}" for s, k, e in spans]


def check(rows, texts):
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        every = r.spans.split(",") if r.spans else []
        assert set(want) <= set(every) and len(every) == len(want) + r.n_added
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x.startswith(k + ":") for x in want) for k in P.KINDS)
        assert every == sorted(every, key=lambda x: (int(x.split(":")[1]), P.KINDS.index(x.split(":")[0]), int(x.split(":")[2])))


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op3_pii_spans(spark, sf).collect()
    assert len(got) == len(texts)
    check(got, texts)
    assert sum(r.n_email for r in got) > 5 and sum(r.n_card for r in got) > 5


PIECES = st.sampled_from(["a.b@c.de", "x_y@z.q_w@e.r", "@", ".", "..", "1.2.3.4", "255.256.1.0", "0001.02.3.4", "1.2.3", "4111111111111111", "4111 1111-1111 1111", "+1 (409) 555-8387", "+", "(", ")", " ", "-", "7",
                          "12", "é", "\U0001f600", "+49 30 123456789", "00", "\n", "a@b", "--", "%+", "+4 .", "9" * 20, "555-123-4567", "user [at] host [dot] org", "1-2-3-4"])


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PIECES, max_size=12).map("".join), min_size=60, max_size=60))
def test_base_spans_of_odd_strings(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    model = P.Boosted([(1, 9, -1.0, 2.0)], 0.0, {"email": None, "ip": None, "card": None, "phone": 0.8})
    check(P.digest(P.find(docs, model)).collect(), dict(enumerate(texts)))


def test_long_runs_and_odd_rows(spark):
    extra = [(30, "9" * 20_000, "en", "s", 1, 0, "", 0), (31, "a" * 20_000 + "@b." + "c." * 3000 + "d", "en", "s", 1, 0, "", 0), (32, "1." * 2000, "en", "s", 1, 0, "", 0),
             (33, "x@y.zz " * 400, "en", "s", 1, 0, "", 0)]
    docs = odd_docs(spark, extra).dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = P.digest(P.find(docs, P.train(docs))).collect()
    assert len(got) == len(texts)
    check(got, texts)
    assert P.digest(P.find(no_docs(spark), P.train(no_docs(spark)))).count() == 0


def test_trees_learn_and_thresholds_select(spark):
    rows = [(i, f"not +{i % 9} {10 + i % 80} but call +1 ({200 + i % 700}) 555-{1000 + i} or see {i}-{i % 90} of ({200 + i % 700}) 555-{1000 + i} now") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = P.train(docs)
    assert model.trees and model.thresholds["phone"] is not None
    got = P.find(docs, model).select(F.explode("added").alias("x")).select("x.*")
    assert got.where(F.col("k") == 3).count() == 400 == got.count()


def test_written_out_addresses_are_candidates_in_either_case(spark):
    rows = [(i, f"mail user{i}@host{i}.org now") for i in range(200)] + [(200 + i, t) for i, t in enumerate(["mail user [AT] host.org now", "mail user [at] host.org now", "mail user (AT) host (DOT) org now"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in P.digest(P.find(docs, P.Boosted([], 9.0, {"email": 0.5}))).collect()}
    assert got[200] == got[201] == "email:5:23" and got[202] == "email:5:29" and got[0] == "email:5:20"


def test_thresholds_count_all_held_out_rows_and_rare_kinds_take_the_common_one(spark):
    x = lambda digits: [0, digits, *[0] * 14]
    tree = (1, 9, -2.0, 2.0)  # more than nine digits: valid
    rows = [(0, x(12), 1.0)] * 60 + [(0, x(3), 0.0)] * 40 + [(2, x(12), 1.0)] * 3 + [(3, x(12), float(i % 2)) for i in range(60)]
    model = P.Boosted([tree], 0.0, {})
    held = spark.createDataFrame(rows, "k int, x array<int>, y double")
    assert P.calibrate(model, held.where("k <> 3")) == {"email": 0.5, "ip": 0.5, "card": 0.5, "phone": 0.5}
    assert P.calibrate(model, held)["phone"] is None and P.calibrate(model, held)["email"] == 0.5
    assert set(P.calibrate(model, held.limit(0)).values()) == {None}


def test_positions_by_splitting(spark, monkeypatch):
    for chunk in (2, 200):
        monkeypatch.setattr(P, "_CHUNK", chunk)
        df = spark.createDataFrame([("\u00e91\U0001f600 22",), ("",), ("333",), ("1 2 3 4 55 6",)], "t string").coalesce(1)
        df = df.select("t", F.regexp_extract_all("t", F.lit("[0-9]+"), F.lit(0)).alias("f"), F.split("t", "[0-9]+", -1).alias("p"))
        for r in df.select("t", P.spans(F.col("f"), F.col("p")).alias("x")).collect():
            assert [(x.s, x.e, x.m) for x in r.x] == [(*m.span(), m.group()) for m in re.finditer("[0-9]+", r.t)]
