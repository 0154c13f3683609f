from __future__ import annotations

import re

import pytest

from contrail.llm import op11_license as L
from contrail.llm.common import documents
from tests.conftest import SF_SMALL
from tests.llm.helpers import LONG, no_docs, odd_docs


def tokens(text):
    return re.findall(L.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def base(text):
    w, out = tokens(text), []
    for t in L.BASE:
        p = t.text.split()
        out += [(i, t.label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    starts = [i for i, _ in out]
    return len(w), len(out), min(starts, default=None), max(starts, default=None), {x for _, x in out}


def spans(text):
    """The method's spans by plain loops: votes by diagonal, neighbours merged, spans verified."""
    w, out = tokens(text), []
    for t in L.NOTICES:
        p = t.text.split()
        k = min(3, len(p))
        runs = len(p) - k + 1
        votes, places = {}, {}
        for j in range(runs):
            places.setdefault(tuple(p[j : j + k]), []).append(j)
        for i, run in enumerate(zip(*(w[x:] for x in range(k)))):
            for j in places.get(run, ()):
                votes.setdefault(i - j, set()).add(j)
        group = []
        for d in [*sorted(votes), None]:
            if group and (d is None or d - group[-1] > len(p) // 4):
                held = set().union(*(votes[x] for x in group))
                first = min(x + min(votes[x]) for x in group)
                last = max(x + max(votes[x]) + k - 1 for x in group)
                if (len(held) >= L.SHARE * runs and last - first + 1 <= L.STRETCH * len(p)) or max(len(votes[x]) for x in group) >= L.SHARE * runs:
                    out.append((t.label, first, last, len(held) / runs))
                group = []
            group.append(d)
    return out


def brute(doc_id, text):
    n, n_base, first, last, labels = base(text)
    own = spans(text)
    return (doc_id, n, n_base, first, last, ",".join(sorted(labels)), ",".join(sorted(labels | {x[0] for x in own})),
            1.0 if labels else max((x[3] for x in own), default=0.0))


def rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score").collect()), key=str)


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software)"
LICENSED = [
    MIT, MIT.replace("free of charge, ", ""), MIT.replace("obtaining a copy", "who gets, at any time, a copy"), MIT.upper(),
    "All rights reserved. ALL RIGHTS\nRESERVED all rights all rights reserved", "cc by cc by CC-BY", "gnu general public license", "General Publıc License",
    "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License. " * 50, "rights reserved all", "permission is hereby granted",
    "Licensed under CC BY-NC 4.0.", LONG + " all rights reserved " + LONG, "cc by cc byé ccby cc_by", "apache license version 2 0",
]


def test_against_brute_force(spark):
    docs = odd_docs(spark, [(100 + i, t, "en", "s", 1, 0, "", 0) for i, t in enumerate(LICENSED)])
    assert rows(L.digest(L.hits(docs))) == sorted((brute(r.doc_id, r.text) for r in docs.collect()), key=str)


@pytest.mark.parametrize("sf_dir", [SF_SMALL, "/root/testdata/sf0.01"])
def test_documents_against_brute_force(spark, sf_dir):
    docs = documents(spark, sf_dir)
    want = sorted((brute(r.doc_id, r.text) for r in docs.collect()), key=str)
    got = rows(L.digest(L.hits(docs)))
    assert got == want
    labels = {x for r in got for x in r[6].split(",")}
    assert {"mit", "apache-2.0", "cc-by-nc", "reserved"} | ({"gpl", "gpl-3.0"} if sf_dir != SF_SMALL else set()) <= labels


def test_changed_notices_keep_their_label_and_prose_has_none(spark):
    texts = [(1, MIT.replace("free of charge, ", "")), (2, MIT.replace("any person", "any natural or legal person")), (3, "to any person in need of a copy of this " * 9)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r for r in L.digest(L.hits(docs)).collect()}
    assert [got[i].labels for i in (1, 2, 3)] == ["mit", "mit", ""]
    assert 0.6 <= got[1].score < 1 and got[3].score == 0
    assert {(r.doc_id, r.label) for r in L.scan(docs).collect()} == {(1, "mit"), (2, "mit")}


def test_own_templates_and_their_bounds(spark):
    docs = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    own = (L.Template("x", "two three"), L.Template("y", "one two three four"))
    assert [r.label for r in L.scan(docs, templates=own).sort("label").collect()] == ["x", "y"]
    with pytest.raises(ValueError):
        L.hits(docs, templates=(L.Template("z", "one"),))


def test_empty_table(spark):
    assert L.digest(L.hits(no_docs(spark))).count() == 0
