"""Findings of round 3 on work that grew with the input: plans, and results with odd rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from contrail.operators import dedup
from contrail.operators.dedup import first_per_key, one_per_seldom_key, with_parent
from contrail.operators.geojoin import within_join


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df) -> list:
    return sorted(map(tuple, df.collect()), key=repr)


def test_seldom_repeated_keys_move_only_their_own_rows(spark, monkeypatch):
    rows = [(i, i % 7, f"p{i}") for i in range(200)] + [(5, 1, "a"), (5, 5, "p5"), (9, 0, None), (None, 1, "x"), (None, 0, "y")]
    df = spark.createDataFrame(rows, "k long, o long, p string")
    want = _rows(first_per_key(df, ["k"], [F.col("o")]).select("k", "o", "p"))
    got = one_per_seldom_key(df, ["k"], [F.col("o")])
    assert got.columns == df.columns and _rows(got) == want
    unique = df.where("k > 9")
    assert "Exchange" not in _plan(one_per_seldom_key(unique, ["k"], [F.col("o")]))
    monkeypatch.setattr(dedup, "FEW_KEYS", 1)
    assert _rows(one_per_seldom_key(df, ["k"], [F.col("o")])) == want


def test_rows_without_parent_leave_in_place(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k long, v string")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    want = [(1, "a"), (1, "b"), (2, "c")]
    got = with_parent(df, parent, "k")
    assert _rows(got) == want and "SortMergeJoin" not in _plan(got)
    assert "Join" not in _plan(with_parent(df.where("k < 3"), parent, "k"))
    monkeypatch.setattr(dedup, "FEW_KEYS", 0)
    assert _rows(with_parent(df, parent, "k")) == want


def test_zones_of_one_centre_meet_a_point_once(spark, monkeypatch):
    from contrail.operators import geojoin
    met = []
    solver = geojoin.with_spheroid_distance
    monkeypatch.setattr(geojoin, "with_spheroid_distance", lambda df, *a: met.append(df) or solver(df, *a))
    points = spark.createDataFrame([(1, 10.0, 20.0), (2, 10.2, 20.0), (3, -45.0, 3.0)], "p long, plat double, plon double")
    zones = spark.createDataFrame([(i, 10.1, 20.0, 1000.0 * i) for i in range(150)] + [(200, 10.1, 20.0, 1000.0), (201, None, 1.0, 1e6)],
                                  "z long, zlat double, zlon double, r double")
    got = {(r.p, r.z) for r in within_join(points, "plat", "plon", zones, "zlat", "zlon", "r").collect()}
    assert got == {(p, z) for p in (1, 2) for z in range(12, 150)}
    assert met[0].count() <= 6  # two points, packs of at most 64 zones


def test_a_task_reads_a_bounded_part_of_a_written_table(spark):
    """Written tables have small row groups and scans are split finely, so that a task sorts a bounded number of rows."""
    import pyarrow.parquet as pq

    from contrail.session import ROW_GROUP_BYTES, configure, write_table
    configure(spark)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"
    rows = spark.range(0, 2_000_000, 1, 1).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.rand(3).alias("c"), F.rand(4).alias("d"))
    files = [f.removeprefix("file:") for f in write_table(rows, "groups").inputFiles()]
    sizes = [m.row_group(i).total_byte_size for m in (pq.ParquetFile(f).metadata for f in files) for i in range(m.num_row_groups)]
    assert len(sizes) > 1 and max(sizes) < 1.5 * ROW_GROUP_BYTES
