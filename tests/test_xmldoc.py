"""XML documents: reserved characters, empty and missing elements, malformed texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.functions.xmldoc import from_document, to_document

SCHEMA = "a string, b string, n int"


def test_values_survive_the_round_trip(spark):
    rows = [("AT&T <x> \"q\" 'p'", " blank ends ", 5), ("]]>", "é\U0001f600", -1), ("&amp;", "<a>1</a>", None), (None, "", 0), (None, None, None), ("line\nbreak", "00", 7)]
    df = spark.createDataFrame(rows, SCHEMA).select(to_document("plan", F.struct("a", "b", "n")).alias("x"))
    assert [tuple(r.p) for r in df.select(from_document("x", "plan", SCHEMA).alias("p")).collect()] == rows
    assert df.where("x like '<plan>%</plan>' or x = '<plan/>' or x = '<plan></plan>'").count() == len(rows)


def test_absent_elements_wrong_types_and_malformed_texts_are_null(spark):
    rows = [("<plan><b>x</b></plan>",), ("<plan><n>zwei</n><a>y</a></plan>",), ("",), (None,), ("no document",)]
    got = spark.createDataFrame(rows, "x string").select(from_document("x", "plan", SCHEMA).alias("p")).select("p.*").collect()
    assert [tuple(r) for r in got] == [(None, "x", None)] + [(None, None, None)] * 4
