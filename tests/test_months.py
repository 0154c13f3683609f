"""Facts by month: default partition, reload of one month, pruning by the calendar."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from contrail.operators.months import DEFAULT, MONTH, MonthLayout
from contrail.session import scratch_path

LAYOUT = MonthLayout(202401, 202412)
ROWS = [(1, 20240105), (2, 20240131), (3, 20240201), (4, 20241231), (5, 20250101), (6, 20231231), (7, None), (8, -20240105)]


@pytest.fixture
def path(spark):
    return scratch_path(spark, f"t/months-{uuid.uuid4().hex}")


def facts(spark, rows):
    return spark.createDataFrame(rows, "id long, tiempo_id int")


def content(df):
    return sorted((r.id, r[MONTH]) for r in df.collect())


def files(df, month):
    return {r[0] for r in df.where(F.col(MONTH) == month).select(F.input_file_name()).distinct().collect()}


def test_dates_without_a_partition_go_to_the_default_one(spark, path):
    back = LAYOUT.write(facts(spark, ROWS), path)
    assert content(back) == [(1, 202401), (2, 202401), (3, 202402), (4, 202412), (5, DEFAULT), (6, DEFAULT), (7, DEFAULT), (8, DEFAULT)]
    assert back.schema[MONTH].dataType.simpleString() == "int" and back.columns == ["id", "tiempo_id", MONTH]


def test_reload_leaves_other_months_untouched_and_can_be_repeated(spark, path):
    back = LAYOUT.write(facts(spark, ROWS), path)
    before = {m: files(back, m) for m in (202402, 202412, DEFAULT)}
    new = facts(spark, [(11, 20240109), (12, 20240301), (13, None)])
    for _ in range(2):
        back = LAYOUT.reload(new, path, [202401])
    assert content(back.where(F.col(MONTH) == 202401)) == [(11, 202401)]
    assert {m: files(back, m) for m in before} == before
    assert back.where("id = 12 or id = 13").count() == 0  # their months were not named
    assert content(LAYOUT.reload(new, path, [DEFAULT]).where(F.col(MONTH) == DEFAULT)) == [(13, DEFAULT)]


def test_a_month_without_rows_becomes_empty(spark, path):
    LAYOUT.write(facts(spark, ROWS), path)
    back = LAYOUT.reload(facts(spark, [(9, 20240302)]), path, [202401, 202403])
    assert content(back) == [(3, 202402), (4, 202412), (5, DEFAULT), (6, DEFAULT), (7, DEFAULT), (8, DEFAULT), (9, 202403)]


def test_empty_table_clashing_column_and_unknown_month(spark, path):
    assert LAYOUT.write(facts(spark, []), path).count() == 0
    with pytest.raises(ValueError):
        LAYOUT.write(facts(spark, ROWS).withColumn(MONTH, F.lit(1)), path)
    with pytest.raises(ValueError):
        LAYOUT.reload(facts(spark, ROWS), path, [202501])


def test_a_calendar_filter_prunes_the_fact(spark, path):
    import re
    many = spark.range(0, 366).select("id", F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")), "yyyyMMdd").cast("int").alias("tiempo_id"))
    back = LAYOUT.write(many.union(facts(spark, [(900, None)])), path)
    cal = scratch_path(spark, f"t/cal-{uuid.uuid4().hex}")
    many.select("tiempo_id", F.floor(F.col("tiempo_id") / 100 % 100).cast("int").alias("mes")).write.parquet(cal)
    got = LAYOUT.on_calendar(back, spark.read.parquet(cal).where("mes in (2, 3)"))
    assert got.count() == 60 and MONTH not in got.columns
    rows = got.collect()
    assert len(rows) == 60 and all(20240201 <= r.tiempo_id <= 20240331 for r in rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan), plan
