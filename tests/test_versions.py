"""Versioned tables, the stored history and the key registry."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from contrail.operators.versions import VersionedTable, append_history, check_history, extend_registry
from contrail.session import scratch_path


@pytest.fixture
def table(spark):
    return VersionedTable(spark, scratch_path(spark, f"t/versions-{uuid.uuid4().hex}"))


def changes(spark, rows):
    return spark.createDataFrame(rows, "id long, operacion string, snapshot_completo string")


def faults(table):
    return sorted(((r.id, r.version, r.falla) for r in check_history(table, "id").collect()), key=str)


@pytest.fixture
def history(spark, table):
    for v, rows in enumerate(([(1, "INSERT", "a"), (2, "INSERT", "b")], [(1, "UPDATE", "c"), (3, "INSERT", None)], [(1, "DELETE", "c"), (2, "UPDATE", "d")]), 1):
        assert append_history(table, changes(spark, rows), "id", v)
    return table


def rewrite(table, version, change):
    from contrail.session import write_table
    rows = table.read().where(F.col("version") == version).drop("version")
    write_table(change(rows), "edited").write.mode("overwrite").parquet(f"{table.data}/version={version}")
    table.spark.catalog.refreshByPath(table.data)


def test_history_is_chained_and_a_repeated_append_adds_nothing(spark, history):
    before = history.read().count()
    assert not append_history(history, changes(spark, [(9, "INSERT", "x")]), "id", 2)
    assert history.read().count() == before == 6 and faults(history) == []
    rows = {(r.id, r.version): r for r in history.read().collect()}
    assert rows[1, 2].hash_previo == rows[1, 1].hash_cadena and rows[1, 3].hash_previo == rows[1, 2].hash_cadena
    assert rows[2, 3].hash_previo == rows[2, 1].hash_cadena and rows[3, 2].hash_previo == ""


def test_an_altered_snapshot_is_found(history):
    rewrite(history, 2, lambda r: r.withColumn("snapshot_completo", F.when(F.col("id") == 1, "z").otherwise(F.col("snapshot_completo"))))
    assert faults(history) == [(1, 2, "HASH"), (None, 2, "MANIFIESTO")]


def test_a_resigned_row_and_a_removed_row_break_the_chain(history):
    forged = F.when(F.col("id") == 1, F.sha2(F.lit("z"), 256)).otherwise(F.col("hash_integridad"))
    rewrite(history, 2, lambda r: r.withColumn("snapshot_completo", F.when(F.col("id") == 1, "z").otherwise(F.col("snapshot_completo"))).withColumn("hash_integridad", forged)
            .withColumn("hash_cadena", F.sha2(F.concat_ws("|", "hash_previo", "operacion", "hash_integridad"), 256)))
    assert faults(history) == [(1, 3, "CADENA"), (None, 2, "MANIFIESTO")]
    rewrite(history, 1, lambda r: r.where("id <> 2"))
    assert (2, 3, "CADENA") in faults(history) and (None, 1, "MANIFIESTO") in faults(history)


def test_a_last_row_that_went_is_found_by_the_manifest(history):
    rewrite(history, 3, lambda r: r.where("id <> 2"))
    assert faults(history) == [(None, 3, "MANIFIESTO")]


def test_a_write_that_was_cut_short_is_written_again(spark, history):
    lost = changes(spark, [(7, "INSERT", "x")])
    lost.write.parquet(f"{history.data}/version=4")  # data without a manifest row: not a version
    assert history.read().where("version = 4").count() == 0
    assert append_history(history, changes(spark, [(8, "INSERT", "y")]), "id", 4)
    assert [r.id for r in history.read().where("version = 4").collect()] == [8] and faults(history) == []


def test_an_empty_table_has_no_rows_and_no_faults(table):
    assert table.read() is None and table.numbers() == [] and faults(table) == []


def test_registered_keys_keep_their_numbers(spark, table):
    def keys(*pairs):
        return spark.createDataFrame(list(pairs), "a string, b int")
    first = {(r.a, r.b): r.n for r in extend_registry(table, keys(("m", 1), ("k", 2), ("k", 2), (None, 3)), ["a", "b"], "n", 1).collect()}
    assert first == {("k", 2): 1, ("m", 1): 2}
    # an earlier key in order is added: everything that has a number keeps it
    second = {(r.a, r.b): r.n for r in extend_registry(table, keys(("a", 9), ("m", 1), ("z", 1)), ["a", "b"], "n", 2).collect()}
    assert second == {**first, ("a", 9): 3, ("z", 1): 4}
    again = extend_registry(table, keys(("q", 1)), ["a", "b"], "n", 2)
    assert again.count() == 4
    assert extend_registry(table, keys(("m", 1)), ["a", "b"], "n", 3).count() == 4
