"""Marts refreshed by changed months: only those are read, a cut refresh is made good."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from contrail.operators.marts import Measures, MonthlyMart, mean
from contrail.operators.months import DEFAULT, MONTH, MonthLayout
from contrail.session import scratch_path

LAYOUT = MonthLayout(202401, 202412)
M = Measures(("k",), {"total": "cast(v as decimal(10,2))"}, {"n": "v", "rows": "1"})
ROWS = [("a", 20240105, 1.25), ("a", 20240106, 2.0), ("b", 20240201, None), ("a", 20240301, 4.0), ("b", 20230101, 8.0), ("b", None, 16.0), (None, 20240105, 32.0)]


def facts(spark, rows):
    return spark.createDataFrame(rows, "k string, tiempo_id int, v double")


@pytest.fixture
def place(spark):
    return scratch_path(spark, f"t/marts-{uuid.uuid4().hex}")


def merged(mart, fact):
    return sorted(((r.k, r.total, r.n, r.rows) for r in M.merge(mart.read(fact), "k").collect()), key=str)


def whole(fact):
    one = fact.groupBy("k").agg(F.sum(F.col("v").cast("decimal(10,2)")), F.count("v"), F.count("*"))
    return sorted((tuple(r) for r in one.collect()), key=str)


def test_only_changed_months_are_read_and_the_mart_equals_one_pass(spark, place):
    fact, mart = LAYOUT.write(facts(spark, ROWS), f"{place}/f"), MonthlyMart(spark, f"{place}/m", LAYOUT, M)
    assert mart.refresh(fact, f"{place}/f") == [DEFAULT, 202401, 202402, 202403]
    assert merged(mart, fact) == whole(fact)
    assert mart.refresh(fact, f"{place}/f") == []

    def files(month):
        return {r[0] for r in mart.read(fact).where(F.col(MONTH) == month).select(F.input_file_name()).distinct().collect()}
    untouched = {m: files(m) for m in (DEFAULT, 202401, 202402)}
    fact = LAYOUT.reload(facts(spark, [("c", 20240302, 0.5), ("a", 20240307, 0.25)]), f"{place}/f", [202403])
    assert mart.refresh(fact, f"{place}/f") == [202403]
    assert merged(mart, fact) == whole(fact)
    assert {m: files(m) for m in untouched} == untouched


def test_an_emptied_month_leaves_the_mart_and_a_cut_refresh_is_done_again(spark, place, monkeypatch):
    fact, mart = LAYOUT.write(facts(spark, ROWS), f"{place}/f"), MonthlyMart(spark, f"{place}/m", LAYOUT, M)
    monkeypatch.setattr(type(mart.state), "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("cut")))
    with pytest.raises(RuntimeError):
        mart.refresh(fact, f"{place}/f")
    monkeypatch.undo()
    assert mart.refresh(fact, f"{place}/f") == [DEFAULT, 202401, 202402, 202403]
    assert merged(mart, fact) == whole(fact)
    fact = LAYOUT.reload(facts(spark, []), f"{place}/f", [202401, DEFAULT])
    assert mart.refresh(fact, f"{place}/f") == [DEFAULT, 202401]
    assert merged(mart, fact) == whole(fact) == [("a", 4, 1, 1), ("b", None, 0, 1)]


def test_sums_that_depend_on_their_order_are_refused_and_means_round_half_up(spark, place):
    with pytest.raises(ValueError):
        Measures(("k",), {"total": "v"}, {}).partial(LAYOUT.with_month(facts(spark, ROWS)), "tiempo_id")
    df = spark.createDataFrame([("1.25", 2), ("0.00", 0), ("-1.25", 2)], "s string, n long").select(F.col("s").cast("decimal(28,2)").alias("s"), "n")
    assert [r[0] for r in df.select(mean("s", "n", 2, 2)).collect()] == [0.63, None, -0.63]
