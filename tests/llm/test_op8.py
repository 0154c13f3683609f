from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from contrail.llm import op8_toxicity as T
from contrail.llm.queries import op8_toxicity
from tests.llm.helpers import no_docs, odd_docs

TERMS = ["scum", "idiot", "trash", "worthless", "disgusting", "loweiä", "stemmed*", "bad*"]
AUTOMATON = T.Automaton(TERMS)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def match(words):
    points = np.array([ord(c) for w in words for c in w], np.int64)
    size = np.array([len(w) for w in words], np.int64)
    term, edits = AUTOMATON.run(points, np.cumsum(size) - size, size)
    return [(e if t >= 0 else None) for t, e in zip(term.tolist(), edits.tolist())]


def brute(word):
    read = "".join(T.ALIKE.get(c, c) if c not in AUTOMATON.code else c for c in word)
    fits = []
    for t in TERMS:
        d = min(distance(read[:k], t[:-1]) for k in range(len(read) + 1)) if t.endswith("*") else distance(read, t)
        if d <= T.Automaton.allowed(t):
            fits.append(d)
    return min(fits, default=None)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.text("abdehilmorstuwä0", max_size=11), st.tuples(st.sampled_from(TERMS), st.integers(0, 11), st.sampled_from("xosä"), st.integers(0, 11))
                          .map(lambda x: (w := x[0][: x[1]] + x[2] + x[0][x[1] + 1 :])[: x[3]] + w[x[3] + 1 :])), min_size=1, max_size=20))
def test_automaton_equals_edit_distance(words):
    assert match(words) == [brute(w) if w else None for w in words]


def test_context_window_tells_quotation_from_abuse():
    x = T.features(pa.array(["you are an idiot and trash, truly", 'he said "you are an idiot" to them', "nothing of the kind", "an 1d1ot or idi0t or idoit", None]), AUTOMATON)
    f = dict(zip(T.FEATURES, x.T))
    assert f["exact"][0] > 0 and f["quoted"][0] == 0 and f["crowded"][0] > 0
    assert f["exact"][1] == 0 and f["quoted"][1] > 0
    assert (x[2] == 0).all() and (x[4] == 0).all() and f["exact"][3] > 0


def test_only_matching_marks_around_a_hit_quote_it():
    plain = ["You’re a worthless idiot, don’t come back", "l’homme qu’on dit idiot d’un mot", "she said it’s an idiot", "\"yes\" you idiot \"no\"",
             "the dogs’ idiot and the cats’ bowl", "a 5\" idiot 6\" long", "he said \"an\n\nidiot\" now", "“well” idiot “then”"]
    quoted = ["“you idiot”, I read", "„so ein idiot“ stand da", "il a dit « quel idiot » hier", "»so ein idiot« stand da", "‘don’t be an idiot’ it read",
              "he wrote \"one two three four five six seven eight idiot one two three four five six seven eight\" there", "\"an idiot.\" he said", "(\"idiot\")", "”en idiot” stod det"]
    x = T.features(pa.array(plain + quoted), AUTOMATON)[:, T.FEATURES.index("quoted")] > 0
    assert x.tolist() == [False] * len(plain) + [True] * len(quoted)


def test_lexicon_finds_words_and_stems(spark):
    rows = [("idiot", 40, 0), *[(f"lowei{x}", 9, 0) for x in "abcdef"], ("idea", 10, 90), ("lower", 5, 60), ("rare", 3, 0), ("the", 100, 900)]
    got = T.lexicon(spark.createDataFrame(rows, "term string, toxic long, other long"), 100, 900)
    assert got == ["idiot", "lowei*"]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op8_toxicity(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen = got.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("toxic")).cast("double")).alias("a"), F.count("*").alias("n")).first()
    assert seen.n > 50 and seen.a > 0.97
    assert got.count() == 10_000


def test_odd_rows(spark):
    docs = odd_docs(spark).withColumn("score", F.lit("clash"))
    labels = spark.createDataFrame([(1, 0), (4, 0), (6, 1), (6, None), (None, 1)], "doc_id long, toxic int")
    for got in (T.score(docs, T.train(docs, labels, F.lit(True))), T.score(docs, T.train(docs, labels.limit(0), F.lit(True)))):
        rows = got.collect()
        assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows) and set(got.columns) == set(docs.columns)
    assert T.score(no_docs(spark), T.train(no_docs(spark), labels, F.lit(True))).count() == 0


def test_terms_of_all_scripts_match():
    automaton = T.Automaton(["白痴垃圾", "쓰레기같은*", "\U0001f595\U0001f595\U0001f595", "scum"])
    texts = ["你 白痴垃圾 的", "이 쓰레기같은것 아", "you \U0001f595\U0001f595\U0001f595 there", "such ｓｃｕｍ and ＳＣＵＭ", "你 白痴 的", "漢字 \U0001f600"]
    x = T.features(pa.array(texts), automaton)
    assert (x[:4, T.FEATURES.index("exact")] > 0).all() and (x[4:] == 0).all()


def test_lexicon_keeps_every_term_that_qualifies(spark):
    words = ["".join(chr(97 + i // k % 26) for k in (676, 26, 1)) + "q" for i in range(600)]
    got = T.lexicon(spark.createDataFrame([(w, 10, 0) for w in words] + [("the", 100, 900)], "term string, toxic long, other long"), 100, 900)
    assert all(any(w == t or (t.endswith("*") and w.startswith(t[:-1])) for t in got) for w in words) and len(got) > 400
