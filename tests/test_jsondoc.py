"""JSON documents as variants: typed fields, defaults for what does not fit."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from contrail.functions.jsondoc import document, field, fields


def test_fields_by_type(spark):
    rows = [('{"s": "x", "n": 12345.678, "b": true, "o": {"d": "2024-01-05"}}',), ('{"s": null, "n": "12.5", "b": "maybe"}',), ("{broken",), (None,), ("[1]",), ('{"s": 7, "n": 1.0E7}',)]
    df = spark.createDataFrame(rows, "t string").coalesce(1).select(document("t").alias("d"))
    got = df.select(field("d", "s").alias("s"), field("d", "n", "decimal(14,2)").alias("n"), field("d", "b", "boolean").alias("b"), field("d", "o.d", "date").alias("day")).collect()
    none = (None,) * 4
    assert [tuple(r) for r in got] == [("x", Decimal("12345.68"), True, dt.date(2024, 1, 5)), (None, Decimal("12.50"), None, None), none, none, none, ("7", Decimal("10000000.00"), None, None)]


def test_members_of_an_object(spark):
    rows = [(1, '{"Y": 150, "C": "20", "z": null, "o": {"p": 1}}'), (2, "{}"), (3, None), (4, "[1, 2]"), (5, "x"), (6, '"text"')]
    df = spark.createDataFrame(rows, "id int, t string").select("id", document("t").alias("d"))
    assert sorted(tuple(r) for r in fields(df, "d").collect() if r.key != "o") == [(1, "C", "20"), (1, "Y", "150"), (1, "z", None)]
