"""Property tests (Hypothesis) for the keyed operators."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail.operators.dedup import asc, desc, first_per_key

rows_st = st.lists(st.tuples(st.integers(0, 5), st.one_of(st.none(), st.integers(-3, 3)), st.integers(0, 3)),
                   min_size=1, max_size=40)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st)
def test_first_per_key_equals_row_number_one(spark, rows):
    # (key, ts nullable, v); duplicates allowed -- the whole row closes the order
    df = spark.createDataFrame(rows, "k int, ts int, v int")
    got = first_per_key(df, ["k"], [*desc("ts", nulls_last=True), F.col("v")])
    w = Window.partitionBy("k").orderBy(F.col("ts").desc_nulls_last(), F.col("v").asc_nulls_first())
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.count() == len({r[0] for r in rows})


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_st)
def test_first_per_key_ascending_nulls_first(spark, rows):
    df = spark.createDataFrame(rows, "k int, ts int, v int")
    got = first_per_key(df, ["k"], [*asc("ts"), F.col("v")])
    w = Window.partitionBy("k").orderBy(F.col("ts").asc_nulls_first(), F.col("v").asc_nulls_first())
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert sorted(got.collect()) == sorted(want.collect())
