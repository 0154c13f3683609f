"""Queries for data-quality and business rules (M1-M16) and audit."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions.det import pick, u
from contrail.operators.audit import signed_history, snapshot_diff, snapshot_json, verify
from contrail.operators.rules import Rule, apply_rules, expectation_counts, split_report
from contrail.operators.versions import VersionedTable, append_history, check_history, extend_registry
from contrail.plans import silver as _s
from contrail.plans.context import Layers
from contrail.plans.queries import _dbl, query
from contrail.session import scratch_path, write_table

AUDIT_TS_FMT = "yyyy-MM-dd HH:mm:ss"


# ---- M1 -----------------------------------------------------------------------
@query
def rule_airline_deactivation(L: Layers) -> DataFrame:
    al = L.airlines.select("aerolinea_id", "codigo_icao")
    change = al.select("aerolinea_id", "codigo_icao", F.lit(True).alias("activa_old"),
                       (u(F.col("aerolinea_id"), "deact") >= 0.3).alias("activa_new"))
    busy = (L.fx.flights.where(F.col("estado").isin("SCHED", "ACTIVE"))
            .groupBy("aerolinea_id").agg(F.count("*").alias("vuelos_activos")))
    j = change.join(busy, "aerolinea_id", "left").withColumn("vuelos_activos", F.coalesce("vuelos_activos", F.lit(0)))
    rule = Rule("M1", F.col("activa_old") & ~F.col("activa_new") & (F.col("vuelos_activos") > 0),
                "No se puede desactivar la aerolinea: tiene vuelos activos o programados")
    return split_report(j, [rule])


# ---- M2 -----------------------------------------------------------------------
def aircraft_hours(L: Layers):
    a = L.fleet.select("aeronave_id", F.col("horas_vuelo").alias("horas_vuelo_totales"), "estado")
    hot = (F.col("horas_vuelo_totales") >= 50000) & (F.col("estado") == "ACTIVO")
    out = a.select("aeronave_id", "horas_vuelo_totales", F.col("estado").alias("estado_anterior"),
                   F.when(hot, "MANTENIMIENTO").otherwise(F.col("estado")).alias("estado"))
    _, _, alerts = apply_rules(a, [], [Rule("MANTENIMIENTO_PREVENTIVO", hot,
                                            "Aeronave enviada a mantenimiento por exceso de horas de vuelo", "MEDIA")],
                               key=["aeronave_id"])
    return out, alerts


@query
def rule_aircraft_hours(L: Layers) -> DataFrame:
    out, alerts = aircraft_hours(L)
    return _dbl(out.join(alerts.select("aeronave_id", F.col("alerta_id").alias("alerta")), "aeronave_id", "left"))


# ---- M3 -----------------------------------------------------------------------
@query
def rule_flight_state(L: Layers) -> DataFrame:
    f = L.fx.flights
    new = (F.when(F.col("llegada_real").isNotNull(), "LANDED")
            .when(F.col("salida_real").isNotNull() & (F.col("estado") == "SCHED"), "ACTIVE")
            .otherwise(F.col("estado")))
    return f.select("vuelo_id", F.col("estado").alias("estado_anterior"), new.alias("estado_nuevo")) \
            .withColumn("cambio", ~F.col("estado_anterior").eqNullSafe(F.col("estado_nuevo")))


# ---- M4 -----------------------------------------------------------------------
def maintenance_state(fleet: DataFrame, events: DataFrame) -> DataFrame:
    """Aircraft state after applying maintenance events in (ts, id) order.

    Per event: check D or OPEN/INPROGRESS sets MANTENIMIENTO; then CLOSED
    sets ACTIVO if the aircraft is in MANTENIMIENTO (so a CLOSED check D sets
    and clears in the same row). The fold reduces to the last "setting"
    event and whether a CLOSED event follows it -- two grouped max_by
    aggregates, combinable map-side, instead of an ordered per-aircraft scan.
    """
    e = events.select("aeronave_id", "evento_id", "fecha_inicio", "tipo_check", "estado")
    sets = (F.col("tipo_check") == "D") | F.col("estado").isin("OPEN", "INPROGRESS")
    closes = F.col("estado") == "CLOSED"
    order = F.struct(F.col("fecha_inicio"), F.col("evento_id"))
    agg = e.groupBy("aeronave_id").agg(
        F.max(F.when(sets, order)).alias("last_set"),
        F.max_by(closes, F.when(sets, order)).alias("last_set_closes"),
        F.max(F.when(closes, order)).alias("last_close"),
        F.count(F.when(sets | closes, 1)).alias("eventos_decisivos"))
    j = fleet.select("aeronave_id", F.col("estado").alias("estado_inicial")).join(agg, "aeronave_id", "left")
    close_after = F.col("last_close").isNotNull() & (F.col("last_set").isNull() | (F.col("last_close") > F.col("last_set")))
    final = (F.when(F.col("last_set").isNotNull(),
                    F.when(F.col("last_set_closes") | close_after, "ACTIVO").otherwise("MANTENIMIENTO"))
              .when((F.col("estado_inicial") == "MANTENIMIENTO") & F.col("last_close").isNotNull(), "ACTIVO")
              .otherwise(F.col("estado_inicial")))
    return j.select("aeronave_id", "estado_inicial", final.alias("estado_final"),
                    F.coalesce("eventos_decisivos", F.lit(0)).alias("eventos_decisivos"))


@query
def rule_maintenance_state(L: Layers) -> DataFrame:
    return maintenance_state(L.fleet, L.maintenance)


# ---- M5 / M6 / M7 / M8 ----------------------------------------------------------
@query
def rule_crew_fatigue(L: Layers) -> DataFrame:
    c = L.fx.crew.select("roster_id", "crew_id", "vuelo_id", "duty_hours", "descanso_horas",
                         F.col("descanso_minimo").cast("decimal(4,2)").alias("descanso_minimo_requerido"))
    c = c.withColumn("descanso_minimo_cumple", F.col("descanso_horas") >= F.col("descanso_minimo_requerido"))
    rules = [Rule("M5_DUTY", F.col("duty_hours") > 12, "ALERTA FATIGA: exceso de horas de duty"),
             Rule("M5_REST", F.col("descanso_horas") < F.col("descanso_minimo_requerido"),
                  "ALERTA FATIGA: descanso insuficiente")]
    return _dbl(split_report(c, rules))


@query
def rule_fuel(L: Layers) -> DataFrame:
    f = L.fx.fuel.select("fuel_id", "vuelo_id", "litros", "masa_kg", "precio_litro_usd")
    f = f.withColumn("costo_total_usd", (F.col("litros") * F.col("precio_litro_usd")).cast("decimal(14,2)"))
    rules = [Rule("M6_LITROS", F.col("litros") > 250000, "EXCESO_COMBUSTIBLE: litros sobre el limite"),
             Rule("M6_MASA", F.col("masa_kg") > F.col("litros") * F.lit(1.2).cast("decimal(2,1)"),
                  "EXCESO_COMBUSTIBLE: masa incoherente con la densidad")]
    return _dbl(split_report(f, rules))


@query
def rule_revenue(L: Layers) -> DataFrame:
    r = L.fx.rule_inputs.select(
        "registro_id", F.col("revenue_usd").alias("passenger_revenue_usd"),
        F.when(F.col("registro_id") % 5 == 0, F.lit(None)).otherwise(F.col("saf_pct") * 10).alias("cargo_revenue_usd"))
    r = r.withColumn("total_revenue_usd", F.coalesce("passenger_revenue_usd", F.lit(0))
                     + F.coalesce("cargo_revenue_usd", F.lit(0)))
    return _dbl(split_report(r, [Rule("M7", F.col("total_revenue_usd") < 0, "REVENUE INVALIDO: negativo")]))


@query
def rule_co2(L: Layers) -> DataFrame:
    hv = L.fact_flight_raw.select("vuelo_id", "fuel_consumed_kg")
    co2 = F.when(F.col("fuel_consumed_kg") > 0,
                 F.round(F.col("fuel_consumed_kg") * F.lit(3.16).cast("decimal(3,2)") / 1000, 2)).otherwise(F.lit(0))
    return _dbl(hv.withColumn("co2_emitted_ton", co2))


# ---- M9 / M10 ---------------------------------------------------------------------
def _lf(L: Layers):
    r = L.fx.rule_inputs.select("registro_id", "load_factor_pct")
    rej = [Rule("M9", (F.col("load_factor_pct") < 0) | (F.col("load_factor_pct") > 100),
                "LOAD FACTOR INVALIDO: fuera de 0-100")]
    al = [Rule("CAPACIDAD_OCIOSA", F.col("load_factor_pct") < 50, "Load Factor bajo - revisar ruta", "BAJA"),
          Rule("ALERTA_OVERBOOKING", F.col("load_factor_pct") > 95, "Load Factor muy alto - posible overbooking", "MEDIA")]
    return r, rej, al


def _eff(L: Layers):
    r = L.fx.rule_inputs.select("registro_id", "efficiency_kg_km", "variation_pct", "saf_pct")
    rej = [Rule("M10_SAF", (F.col("saf_pct") < 0) | (F.col("saf_pct") > 100), "SAF INVALIDO: fuera de 0-100")]
    al = [Rule("EFICIENCIA_ANOMALA", F.col("efficiency_kg_km") > 0.10, "kg/km supera el rango realista", "MEDIA"),
          Rule("VARIACION_CRITICA", F.abs(F.col("variation_pct")) > 10, "Eficiencia vario mas de 10% vs plan", "ALTA")]
    return r, rej, al


@query
def rule_load_factor(L: Layers) -> DataFrame:
    r, rej, al = _lf(L)
    return _dbl(split_report(r, rej, al))


@query
def rule_fuel_efficiency(L: Layers) -> DataFrame:
    r, rej, al = _eff(L)
    return _dbl(split_report(r, rej, al))


@query
def alerts_union(L: Layers) -> DataFrame:
    """The operational alerts table, fed by M2, M9 and M10."""
    _, a2 = aircraft_hours(L)
    r9, j9, a9 = _lf(L)
    r10, j10, a10 = _eff(L)
    _, _, al9 = apply_rules(r9, j9, a9, key=["registro_id"])
    _, _, al10 = apply_rules(r10, j10, a10, key=["registro_id"])
    parts = [a2.select(F.lit("aeronaves").alias("tabla_origen"), F.col("aeronave_id").alias("registro_id"),
                       "alerta_id", "mensaje", "severidad"),
             al9.select(F.lit("hechos_pasajero").alias("tabla_origen"), "registro_id", "alerta_id", "mensaje", "severidad"),
             al10.select(F.lit("hechos_combustible").alias("tabla_origen"), "registro_id", "alerta_id", "mensaje",
                         "severidad")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---- M11-M16 ------------------------------------------------------------------------
@query
def dq_check_domains(L: Layers) -> DataFrame:
    f = expectation_counts(L.fx.flights, "vuelos", {
        "estado_dominio": F.col("estado").isin("SCHED", "ACTIVE", "LANDED", "DIVERTED", "CANCEL"),
        "motivo_dominio": F.col("motivo_desviacion").isin("WEATHER", "TECHNICAL", "ATC", "CREW", "GROUND")})
    c = expectation_counts(L.fx.crew, "tripulacion", {
        "rol_dominio": F.col("rol").isin("CAPTAIN", "FO", "RELIEF_CAPTAIN", "PURSER", "FA", "LOADMASTER")})
    g = expectation_counts(L.fx.cargo, "carga", {
        "tipo_dominio": F.col("tipo_carga").isin("GENERAL", "PERECIBLE", "PELIGROSA", "VALORADA", "ANIMALES")})
    return f.unionByName(c).unionByName(g)


@query
def dq_check_ranges(L: Layers) -> DataFrame:
    f = expectation_counts(L.fx.flights, "vuelos", {
        "llegada_despues_salida": F.col("llegada_programada") >= F.col("salida_programada"),
        "llegada_real_despues_salida_real": F.col("llegada_real") >= F.col("salida_real")})
    w = expectation_counts(L.fx.airways, "aerovias", {"nivel_max_mayor_min": F.col("nivel_max") >= F.col("nivel_min")})
    n = expectation_counts(L.fx.notams, "notams", {
        "vigencia_ordenada": F.col("valido_hasta") >= F.col("valido_desde"),
        "radio_rango": F.col("radio_nm").between(0, 100)})
    m = expectation_counts(L.maintenance, "mantenimiento", {"fin_despues_inicio": F.col("fecha_fin") >= F.col("fecha_inicio")})
    return f.unionByName(w).unionByName(n).unionByName(m)


@query
def dq_not_null(L: Layers) -> DataFrame:
    cols = ["numero_vuelo", "aerolinea_id", "aeronave_id", "origen_id", "destino_id", "salida_programada",
            "llegada_programada", "salida_real", "llegada_real", "estado", "motivo_desviacion"]
    return expectation_counts(L.fx.flights, "vuelos", {f"{c}_no_nulo": F.col(c).isNotNull() for c in cols})


@query
def dq_unique(L: Layers) -> DataFrame:
    def dups(df, table, key):
        g = df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)
        return g.agg(F.count("*").alias("claves_duplicadas"), F.coalesce(F.sum("n"), F.lit(0)).alias("filas_duplicadas")) \
                .select(F.lit(table).alias("tabla"), F.lit(key).alias("clave"), "claves_duplicadas", "filas_duplicadas")
    return (dups(L.fx.flights, "vuelos", "vuelo_id").unionByName(dups(L.fx.bookings, "pasajeros_vuelo", "pv_id"))
            .unionByName(dups(L.fx.cargo, "carga_vuelo", "awb")).unionByName(dups(L.fx.navaids, "navaids", "ident"))
            .unionByName(dups(L.fx.flights.where(F.length("numero_vuelo") > 0), "vuelos", "numero_vuelo")))


@query
def dq_foreign_key(L: Layers) -> DataFrame:
    def orphans(child, table, fk, parent, pk):
        o = child.select(F.col(fk).alias("_k")).where(F.col("_k").isNotNull()).join(
            parent.select(F.col(pk).alias("_k")).distinct(), "_k", "left_anti")
        return o.agg(F.count("*").alias("huerfanos")).select(F.lit(table).alias("tabla"), F.lit(fk).alias("columna"),
                                                             "huerfanos")
    fx = L.fx
    return (orphans(fx.bookings, "pasajeros_vuelo", "vuelo_id", fx.flights, "vuelo_id")
            .unionByName(orphans(fx.bookings, "pasajeros_vuelo", "pasajero_id", fx.passengers, "pasajero_id"))
            .unionByName(orphans(fx.positions, "posicionamiento", "vuelo_id", fx.flights, "vuelo_id"))
            .unionByName(orphans(fx.fuel, "combustible", "aeropuerto_id", fx.airports, "aeropuerto_id"))
            .unionByName(orphans(fx.notams, "notams", "aeropuerto_id", fx.airports, "aeropuerto_id"))
            .unionByName(orphans(fx.maintenance, "mantenimiento", "aeronave_id", L.fleet, "aeronave_id")))


# ---- N1-N4 ---------------------------------------------------------------------------
def _flight_changes(L: Layers) -> DataFrame:
    return snapshot_diff(L.fx.snapshot_old, L.fx.snapshot_new, "vuelo_id", ["estado"])


@query
def audit_state_changes(L: Layers) -> DataFrame:
    return _flight_changes(L).select("vuelo_id", F.col("old_estado").alias("estado_anterior"),
                                     F.col("new_estado").alias("estado_nuevo"), "operacion")


def flight_history(L: Layers) -> DataFrame:
    ch = _flight_changes(L).where(F.col("operacion") != "DELETE").select("vuelo_id", "operacion", "old_estado")
    new = L.fx.snapshot_new.select("vuelo_id", "numero_vuelo", "estado", "salida_programada", "origen_id", "destino_id")
    j = ch.join(new, "vuelo_id")
    snap = snapshot_json([F.col("vuelo_id"), F.col("numero_vuelo"), F.col("estado"),
                          F.date_format("salida_programada", AUDIT_TS_FMT).alias("salida_programada"),
                          F.col("origen_id"), F.col("destino_id")])
    h = signed_history(j, snap)
    return h.select("vuelo_id", "numero_vuelo", F.when(F.col("operacion") == "UPDATE", F.col("old_estado"))
                    .alias("estado_anterior"), F.col("estado").alias("estado_nuevo"), "operacion",
                    "snapshot_completo", "hash_integridad")


@query
def audit_snapshot_hash(L: Layers) -> DataFrame:
    return flight_history(L)


@query
def audit_verify(L: Layers) -> DataFrame:
    """A keyed 20 % of stored snapshots is edited; verify finds exactly those."""
    h = flight_history(L)
    tampered = h.withColumn("snapshot_completo", F.when(
        u(F.col("vuelo_id"), "tamper") < 0.2,
        F.replace(F.col("snapshot_completo"), F.lit('"estado":"'), F.lit('"estado":"X'))).otherwise(F.col("snapshot_completo")))
    return verify(tampered).select("vuelo_id", "operacion", "hash_integridad")


@query
def audit_passenger_changes(L: Layers) -> DataFrame:
    p = L.fx.passengers.select("pasajero_id", "nombre", "nacionalidad", "categoria")
    k = F.col("pasajero_id")
    old = p.where(u(k, "pax_add") >= 0.02)
    new = (p.where(u(k, "pax_del") >= 0.02)
           .withColumn("nacionalidad", F.when(u(k, "pax_upd") < 0.05, F.lit("XX")).otherwise(F.col("nacionalidad"))))
    d = snapshot_diff(old, new, "pasajero_id", ["nombre", "nacionalidad", "categoria"])
    return d.select("pasajero_id", "operacion", "old_nacionalidad", "new_nacionalidad")


# ---- stored history and keys -----------------------------------------------------------
def _snapshot_text(prefix: str = "") -> Column:
    c = {n: F.col(prefix + n) for n in ("vuelo_id", "numero_vuelo", "estado", "salida_programada", "origen_id", "destino_id")}
    c["salida_programada"] = F.date_format(c["salida_programada"], AUDIT_TS_FMT)
    return snapshot_json([v.alias(n) for n, v in c.items()])


def stored_history(L: Layers) -> VersionedTable:
    """Version 1: every flight of the old snapshot. Version 2: what the new one changes; a repeated commit adds nothing."""
    table = VersionedTable(L.spark, scratch_path(L.spark, f"history/flights-{uuid.uuid4().hex}"))
    old = L.fx.snapshot_old.select("vuelo_id", F.lit("INSERT").alias("operacion"), _snapshot_text().alias("snapshot_completo"))
    ch = _flight_changes(L).select("vuelo_id", "operacion")
    now = L.fx.snapshot_new.select("vuelo_id", _snapshot_text().alias("_new"))
    was = old.select("vuelo_id", F.col("snapshot_completo").alias("_old"))
    changes = ch.join(now, "vuelo_id", "left").join(was, "vuelo_id", "left").select(
        "vuelo_id", "operacion", F.when(F.col("operacion") == "DELETE", F.col("_old")).otherwise(F.col("_new")).alias("snapshot_completo"))
    for version, rows in ((1, old), (2, changes), (2, changes)):
        append_history(table, rows, "vuelo_id", version)
    return table


@query
def audit_history(L: Layers) -> DataFrame:
    """The stored, chained history of flights."""
    return stored_history(L).read().select("vuelo_id", "version", "operacion", "hash_integridad", "hash_previo", "hash_cadena")


@query
def audit_history_check(L: Layers) -> DataFrame:
    """A keyed fifth of the stored second version is edited in place; the check names it and the version."""
    table = stored_history(L)
    v2 = table.read().where("version = 2").drop("version")
    edited = v2.withColumn("snapshot_completo", F.when(
        u(F.col("vuelo_id"), "tamper") < 0.2, F.concat(F.col("snapshot_completo"), F.lit(" "))).otherwise(F.col("snapshot_completo")))
    elsewhere = write_table(edited, "edited_history")  # the folder that is overwritten is also read
    elsewhere.write.mode("overwrite").parquet(f"{table.data}/version=2")
    L.spark.catalog.refreshByPath(table.data)
    return check_history(table, "vuelo_id")


@query
def route_registry(L: Layers) -> DataFrame:
    """Routes numbered in two loads, flights to 1996 first; no number of the first load changes."""
    f = L.fx.flights.select("origen_id", "destino_id", "salida_programada")
    table = VersionedTable(L.spark, scratch_path(L.spark, f"keys/routes-{uuid.uuid4().hex}"))
    extend_registry(table, f.where(F.year("salida_programada") <= 1996), ["origen_id", "destino_id"], "ruta_id", 1)
    return extend_registry(table, f, ["origen_id", "destino_id"], "ruta_id", 2)
