"""Operators: dedup, dense ids, skew-safe LEAD, rules, audit, geocell joins, sinks."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from contrail.functions.geo import with_spheroid_distance
from contrail.operators.audit import signed_history, snapshot_diff, snapshot_json, verify
from contrail.operators.dedup import desc, first_per_key
from contrail.operators.geojoin import nearest_join, within_join
from contrail.operators.ids import dense_index
from contrail.operators.rules import Rule, apply_rules
from contrail.operators import sinks
from contrail.operators.windows import lead_by_key
from contrail.session import scratch_path


def test_first_per_key_matches_window_and_keeps_one_row(spark):
    rnd = random.Random(7)
    # key 0 is hot: a third of the rows
    rows = [(0 if i % 3 == 0 else rnd.randint(1, 50), rnd.randint(0, 1000), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, ts int, id int")
    got = first_per_key(df, ["k"], [*desc("ts"), F.col("id")])
    w = Window.partitionBy("k").orderBy(F.col("ts").desc(), F.col("id"))
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert got.count() == df.select("k").distinct().count()
    assert sorted(got.collect()) == sorted(want.select("k", "ts", "id").collect())


def test_dense_index_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5003).alias("v"))
    out = dense_index(df, ["v"], "ix").orderBy("v").collect()
    assert [r.ix for r in out] == list(range(1, 5001))


def test_lead_by_key_equals_window_lead_with_hot_key(spark):
    rnd = random.Random(3)
    rows = [(0 if i % 2 == 0 else rnd.randint(1, 20), rnd.randint(0, 10_000), i, f"F{i}") for i in range(4000)]
    df = spark.createDataFrame(rows, "p int, t int, id int, fn string")
    got = lead_by_key(df, "p", ["t", "id"], "fn", "nxt", num_partitions=16)
    w = Window.partitionBy("p").orderBy("t", "id")
    want = df.withColumn("nxt", F.lead("fn").over(w))
    assert sorted(got.select("id", "nxt").collect()) == sorted(want.select("id", "nxt").collect())


def test_apply_rules_partitions_rows(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 130 - 10).alias("lf"))
    acc, rej, al = apply_rules(df, [Rule("R", (F.col("lf") < 0) | (F.col("lf") > 100), "bad")],
                               [Rule("LOW", F.col("lf") < 50, "low"), Rule("HIGH", F.col("lf") > 95, "high")])
    assert acc.count() + rej.count() == 1000
    assert rej.where("lf between 0 and 100").count() == 0
    assert al.where("alerta_id = 'LOW'").count() == df.where("lf < 50").count()


def _fold(initial, events):
    state = initial
    for _, _, check, estado in sorted(events):
        if check == "D" or estado in ("OPEN", "INPROGRESS"):
            state = "MANTENIMIENTO"
        if estado == "CLOSED" and state == "MANTENIMIENTO":
            state = "ACTIVO"
    return state


def test_maintenance_state_reduction_equals_fold(spark):
    from contrail.plans.rules_q import maintenance_state
    rnd = random.Random(11)
    fleet = [(a, rnd.choice(["ACTIVO", "MANTENIMIENTO", "INACTIVO"])) for a in range(60)]
    ev = [(rnd.randrange(60), i, rnd.randint(0, 50), rnd.choice(["A", "B", "C", "D", "LINE"]),
           rnd.choice(["CLOSED", "INPROGRESS", "OPEN", "DEFERRED"])) for i in range(900)]
    fdf = spark.createDataFrame(fleet, "aeronave_id int, estado string")
    edf = spark.createDataFrame(ev, "aeronave_id int, evento_id int, t int, tipo_check string, estado string") \
        .withColumn("fecha_inicio", F.timestamp_seconds("t"))
    got = {r.aeronave_id: r.estado_final for r in maintenance_state(fdf, edf).collect()}
    for a, s0 in fleet:
        mine = [(t, i, c, e) for (x, i, t, c, e) in ev if x == a]
        assert got[a] == _fold(s0, mine), a


def test_audit_detects_tampering(spark):
    old = spark.createDataFrame([(1, "SCHED"), (2, "ACTIVE"), (3, None)], "id int, estado string")
    new = spark.createDataFrame([(1, "ACTIVE"), (3, None), (4, "SCHED")], "id int, estado string")
    d = snapshot_diff(old, new, "id", ["estado"])
    ops = {r.id: r.operacion for r in d.collect()}
    assert ops == {1: "UPDATE", 2: "DELETE", 4: "INSERT"}
    h = signed_history(d, snapshot_json([F.col("id"), F.col("new_estado")]))
    assert verify(h).count() == 0
    bad = h.withColumn("snapshot_completo", F.concat("snapshot_completo", F.lit(" ")))
    assert verify(bad).count() == h.count()


def _brute_within(points, zones):
    j = points.crossJoin(zones)
    return with_spheroid_distance(j, "_m", "plat", "plon", "zlat", "zlon").where(F.col("_m") <= F.col("r"))


def test_within_join_equals_brute_force_including_poles_and_antimeridian(spark):
    rnd = random.Random(5)
    pts = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(3000)]
    pts += [(10_000 + i, 89.9, rnd.uniform(-180, 180)) for i in range(50)]
    pts += [(20_000 + i, rnd.uniform(-1, 1), 179.95 if i % 2 else -179.95) for i in range(50)]
    zones = [(z, rnd.uniform(-90, 90), rnd.uniform(-180, 180), rnd.uniform(10_000, 600_000)) for z in range(200)]
    zones += [(900, 89.5, 0.0, 200_000.0), (901, 0.0, 180.0, 150_000.0), (902, -0.5, -179.9, 90_000.0)]
    p = spark.createDataFrame(pts, "pid int, plat double, plon double")
    z = spark.createDataFrame(zones, "zid int, zlat double, zlon double, r double")
    got = within_join(p, "plat", "plon", z, "zlat", "zlon", "r").select("pid", "zid")
    want = _brute_within(p, z).select("pid", "zid")
    assert sorted(got.collect()) == sorted(want.collect())
    assert got.count() > 0


def test_nearest_join_equals_brute_force(spark):
    rnd = random.Random(9)
    sites = [(s, rnd.uniform(-60, 60), rnd.uniform(-180, 180)) for s in range(300)]
    pts = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(2000)]
    s = spark.createDataFrame(sites, "sid int, slat double, slon double")
    p = spark.createDataFrame(pts, "pid int, plat double, plon double")
    got = {r.pid: r.sid for r in nearest_join(p, "pid", "plat", "plon", s, "sid", "slat", "slon").collect()}
    d = with_spheroid_distance(p.crossJoin(s), "d", "plat", "plon", "slat", "slon")
    want = {r.pid: r.b.sid for r in d.groupBy("pid").agg(F.min(F.struct("d", "sid")).alias("b")).collect()}
    assert got == want


def test_within_join_over_radius_classes_and_window_ends(spark):
    rnd = random.Random(6)
    day = 86400
    t0 = 1704067200
    pts = [(i, rnd.uniform(-80, 80), rnd.uniform(-180, 180), t0 + rnd.randrange(4 * day)) for i in range(1500)]
    pts += [(5000 + i, 10.0 + 0.001 * i, 20.0, t0 + i * 3600) for i in range(72)] + [(9000, 10.0, 20.0, None), (9001, None, 20.0, t0)]
    radii = [0.0, 300.0, 1000.0, 4000.0, 16_000.0, 64_001.0, 250_000.0, 1_000_000.0, 8_000_000.0]
    zones = [(z, rnd.uniform(-80, 80), rnd.uniform(-180, 180), radii[z % 9], t0 + rnd.randrange(-day, 3 * day), None if z % 7 == 0 else t0 + rnd.randrange(4 * day)) for z in range(90)]
    zones += [(200 + k, 10.0, 20.0, r, t0 + 5 * 3600, t0 + 30 * 3600) for k, r in enumerate(radii)]  # both ends are whole hours that points have
    zones += [(300, 10.0, 20.0, 5000.0, None, t0 + 3600), (301, 10.0, 20.0, 5000.0, None, None), (302, 10.0, 20.0, None, None, None), (303, 10.0, 20.0, 5000.0, t0 + 7200, t0 + 3600)]
    p = spark.createDataFrame(pts, "pid int, plat double, plon double, s long").withColumn("t", F.timestamp_seconds("s").cast("timestamp_ntz"))
    z = spark.createDataFrame(zones, "zid int, zlat double, zlon double, r double, f long, u long").select(
        "zid", "zlat", "zlon", "r", *[F.timestamp_seconds(c).cast("timestamp_ntz").alias(n) for c, n in (("f", "since"), ("u", "until"))])
    got = within_join(p, "plat", "plon", z, "zlat", "zlon", "r", "t", "since", "until").select("pid", "zid")
    want = _brute_within(p, z).where("t is not null and (since is null or t >= since) and (until is null or t <= until)").select("pid", "zid")
    assert sorted(got.collect()) == sorted(want.collect())
    assert {r.zid for r in got.collect()} >= {202, 205, 300, 301}


def test_nearest_join_clustered_sites_and_far_points(spark):
    from contrail.operators.geojoin import candidate_cells
    rnd = random.Random(10)
    sites = [(s, 48.0 + rnd.gauss(0, 0.2), 2.0 + rnd.gauss(0, 0.2)) for s in range(900)] + [(900, -89.99, 10.0), (901, 5.0, 179.99)] + [(902 + i, 48.0, 2.0) for i in range(30)]
    pts = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(300)] + [(1000 + i, 48.0 + rnd.gauss(0, 0.3), 2.0 + rnd.gauss(0, 0.3)) for i in range(300)] + [(2000, 5.0, -179.99), (2001, -90.0, -170.0)]
    s = spark.createDataFrame(sites, "sid int, slat double, slon double")
    p = spark.createDataFrame(pts, "pid int, plat double, plon double")
    got = {r.pid: r.sid for r in nearest_join(p, "pid", "plat", "plon", s, "sid", "slat", "slon").collect()}
    d = with_spheroid_distance(p.crossJoin(s), "d", "plat", "plon", "slat", "slon")
    want = {r.pid: r.b.sid for r in d.groupBy("pid").agg(F.min(F.struct(F.round("d", 3), "sid")).alias("b")).collect()}
    assert got == want
    far = p.where("pid < 1000").selectExpr("plat as _plat", "plon as _plon")
    pairs, depth = candidate_cells(far, s.selectExpr("slat as _slat", "slon as _slon"))
    assert depth >= 4 and pairs.count() < 40 * 300  # no grid of empty cells is listed for points far from all sites


def test_few_sites_a_point_are_compared_and_the_nearest_is_among_them(spark):
    from contrail.functions.geo import with_near_distance
    from contrail.operators.geojoin import _nearest_on_sphere, _on_sphere
    rnd = random.Random(12)
    sites = [(s, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for s in range(200)] + [(200, 10.0, 20.0), (201, 10.0, 20.0), (202, -90.0, 0.0), (203, float("nan"), 0.0)]
    pts = [(i, rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for i in range(300)] + [(300, -10.0, -160.0), (301, 10.0, 20.0), (302, -90.0, 55.0), (302, 10.0, 20.1), (None, 0.0, 0.0)]
    s = spark.createDataFrame(sites, "_sid int, _slat double, _slon double")
    p = spark.createDataFrame(pts, "_pid int, _plat double, _plon double")

    def best(met):
        met = with_near_distance(met, "_d", "_plat", "_plon", "_slat", "_slon")
        return {r._pid: r.b for r in met.groupBy("_pid").agg(F.min(F.struct("_d", "_sid")).alias("b")).collect()}
    near = _nearest_on_sphere(p.crossJoin(s.withColumn("_sp", _on_sphere("_slat", "_slon")).agg(F.collect_list(F.struct("_sid", "_slat", "_slon", "_sp")).alias("_sites"))))
    assert len(pts) <= near.count() < 2 * len(pts)  # of 200 sites; all were compared and sorted before
    assert best(near) == best(p.crossJoin(s))
    # a point opposite all sites keeps every one that the coarse formula could put first
    far = p.where("_pid = 300").crossJoin(s.where("_sid between 200 and 201").withColumn("_sp", _on_sphere("_slat", "_slon")).agg(F.collect_list(F.struct("_sid", "_slat", "_slon", "_sp")).alias("_sites")))
    assert _nearest_on_sphere(far).count() == 2


def test_nearest_join_keeps_points_without_a_site(spark):
    p = spark.createDataFrame([(1, 10.0, 20.0), (2, None, 20.0), (3, 5.0, None)], "pid int, plat double, plon double")
    s = spark.createDataFrame([(7, 10.0, 21.0, "x")], "sid int, slat double, slon double, nombre string")
    for sites, near in ((s, (7, "x")), (s.where("sid < 0"), (None, None))):
        got = nearest_join(p, "pid", "plat", "plon", sites, "sid", "slat", "slon", site_cols=["nombre"])
        assert set(got.columns) == {"pid", "sid", "nombre", "dist_m"}
        assert {r.pid: (r.sid, r.nombre) for r in got.collect()} == {1: near, 2: (None, None), 3: (None, None)}


def test_flights_of_unknown_airlines_stay(spark):
    from contrail.plans.silver import airline_dim, clean_flights
    f = spark.createDataFrame([(1, "DLH0001", 1, 2), (2, "AVA0001", 1, 2)], "vuelo_id int, numero_vuelo string, origen_id int, destino_id int")
    f = f.select("*", *[F.lit(None).cast("string").alias(c) for c in ("salida_programada", "llegada_programada", "estado")])
    a = spark.createDataFrame([(1, "AAAA"), (2, "BBBB")], "aeropuerto_id int, ident string")
    got = {r.numero_vuelo: r.aerolinea for r in clean_flights(f, a, airline_dim(spark)).collect()}
    assert got["DLH0001"] == "Unknown Airline" and got["AVA0001"] not in (None, "Unknown Airline")


def test_missing_batches_are_no_state_but_other_failures_raise(spark, tmp_path):
    import pytest
    from contrail.streaming.keyed import KeyedState, latest_row
    fold = latest_row(["k"], ["v"], [])
    assert KeyedState(spark, str(tmp_path / "none"), fold).read() is None
    broken = tmp_path / "broken" / "lotes" / "tramo=0" / "batch_id=0"
    broken.mkdir(parents=True)
    (broken / "part-0.parquet").write_text("not a parquet file")
    with pytest.raises(Exception):
        KeyedState(spark, str(tmp_path / "broken"), fold).read().count()


def test_partitioned_overwrite_is_idempotent(spark):
    path = scratch_path(spark, f"t/part-{uuid.uuid4().hex}")
    df = spark.range(0, 1000).select(F.col("id"), (F.lit(202401) + F.col("id") % 3).alias("yyyymm"))
    sinks.write_partitioned(df, path)
    sinks.write_partitioned(df, path)
    assert spark.read.parquet(path).count() == 1000
    pruned = sinks.read_months(spark, path, 202401, 202401)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(yyyymm" in plan   # month filter prunes directories
    assert pruned.count() == 334


def test_insert_ignore_keeps_first_copy(spark):
    path = scratch_path(spark, f"t/ign-{uuid.uuid4().hex}")
    a = spark.range(0, 100).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    b = spark.range(50, 150).select(F.col("id").alias("k"), F.lit("b").alias("v"))
    sinks.insert_ignore(spark, a, path, ["k"])
    sinks.insert_ignore(spark, b, path, ["k"])
    sinks.insert_ignore(spark, b, path, ["k"])
    t = spark.read.parquet(path)
    assert t.count() == 150 and t.where("v = 'a'").count() == 100


def test_spread_splits_only_under_split_inputs(spark):
    from contrail.sources.tables import spread
    n = spark.sparkContext.defaultParallelism
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one).rdd.getNumPartitions() == n
    many = spark.range(0, 1000, numPartitions=n * 2)
    assert spread(many) is many   # already split: no exchange added


def test_staged_build_writes_each_table_once(spark):
    from tests.conftest import SF_SMALL
    from contrail.plans import context
    from contrail.plans.context import BUILD_STAGES, Layers
    L = Layers(spark, SF_SMALL)
    L.build(threads=4)
    app = spark.sparkContext.applicationId
    mine = {k[2]: v for k, v in context._STORE.items() if k[0] == app and k[1] == SF_SMALL}
    names = {p.split(".")[-1] for stage in BUILD_STAGES for p in stage}
    assert {n.replace("fx_", "") for n in mine} >= names
    again = Layers(spark, SF_SMALL)
    again.build(threads=4)   # a second build reuses every written table
    assert again.months("fact_flight") is mine["fact_flight"]
    assert set(again.fact_flight.inputFiles()) == set(L.fact_flight.inputFiles())


def test_airline_code_lengths_can_fail(spark):
    from contrail.operators.rules import code_lengths, expectation_counts
    df = spark.createDataFrame([("AV", "AVA", "CO"), (" AV ", " AVA", "CO "), ("AVX", "AVAX", "COL"), (None, None, None), ("", "AVAXY", "CO")],
                               "codigo_iata string, codigo_icao string, pais_base string")
    got = expectation_counts(df, "aerolineas", code_lengths({"codigo_iata": 2, "codigo_icao": 3, "pais_base": 2})).collect()
    assert {(r.regla, r.violaciones, r.filas) for r in got} == {("codigo_iata", 1, 5), ("codigo_icao", 2, 5), ("pais_base", 1, 5)}
