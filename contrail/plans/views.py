"""Views and materialized views (V1-V18) plus the remaining fact queries.

Fan-out fixes of the reference are applied (T4, T5): every child table is
aggregated to the grain of its join key before joining, so no measure is
multiplied by another child's row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.conform import avg_dec, minutes_between
from contrail.functions.jsondoc import document, field
from contrail.operators.dedup import desc, first_per_key
from contrail.operators.windows import lead_by_key
from contrail.plans.context import Layers
from contrail.plans.queries import _dbl, query

NOTAM_AS_OF = "2024-01-15 12:00:00"   # replaces CURRENT_TIMESTAMP (trap T11)
MAINT_AS_OF = "2024-02-01 00:00:00"
PAX_AS_OF = "2026-01-01"


def _r(c, n=2):
    return F.round(c, n).cast("double")


def airport_code(prefix: str, ap: DataFrame, id_col: str) -> DataFrame:
    """COALESCE(NULLIF(iata,''), NULLIF(icao,''), ident) as ``prefix``."""
    code = F.coalesce(F.nullif(F.col("iata"), F.lit("")), F.nullif(F.col("icao"), F.lit("")), F.col("ident"))
    return ap.select(F.col("aeropuerto_id").alias(id_col), code.alias(prefix))


# ---- remaining facts and dims ------------------------------------------------
@query
def dim_passenger_segment(L: Layers) -> DataFrame:
    return L.dim_segment


@query
def dim_crew_role(L: Layers) -> DataFrame:
    return L.dim_crew_role


@query
def fuel_backfill(L: Layers) -> DataFrame:
    from contrail.plans.gold import fuel_backfill as fb
    return _dbl(fb(L.fx.flights, L.fuel_landed))


@query
def fact_passenger(L: Layers) -> DataFrame:
    return _dbl(L.fact_passenger_raw)


@query
def fact_passenger_yield_fill(L: Layers) -> DataFrame:
    return _dbl(L.fact_passenger.select("pv_id", "revenue_pax_km", "yield_usd_rpk"))


@query
def fact_cargo(L: Layers) -> DataFrame:
    return L.fact_cargo


@query
def fact_fuel(L: Layers) -> DataFrame:
    return L.fact_fuel


@query
def fact_maintenance(L: Layers) -> DataFrame:
    return L.fact_maintenance


@query
def fact_crew(L: Layers) -> DataFrame:
    return L.fact_crew


# ---- V1 ---------------------------------------------------------------------
@query
def flight_operations_view(L: Layers) -> DataFrame:
    f = L.fx.flights
    pv = L.fx.bookings.groupBy("vuelo_id").agg(
        F.count_distinct("pasajero_id").alias("pasajeros_totales"),
        F.sum(F.coalesce("equipaje_piezas", F.lit(0))).alias("equipaje_total_piezas"),
        F.sum(F.coalesce("peso_equipaje_kg", F.lit(0))).alias("equipaje_total_kg"),
        F.sum(F.coalesce("tarifa_usd", F.lit(0))).alias("revenue_pasajeros_usd"))
    cv = L.cargo.groupBy("vuelo_id").agg(F.sum(F.coalesce("peso_kg", F.lit(0))).alias("carga_total_kg"))
    al = L.airlines.select("aerolinea_id", F.col("nombre").alias("aerolinea"), "codigo_iata", "codigo_icao")
    an = L.fleet.select("aeronave_id", "matricula", F.col("tipo").alias("tipo_aeronave"),
                        F.col("estado").alias("estado_aeronave"))
    ap = L.fx.airports
    ao = ap.select(F.col("aeropuerto_id").alias("origen_id"), F.col("nombre").alias("aeropuerto_origen"),
                   F.col("iata").alias("origen_iata"), F.col("icao").alias("origen_icao"))
    ad = ap.select(F.col("aeropuerto_id").alias("destino_id"), F.col("nombre").alias("aeropuerto_destino"),
                   F.col("iata").alias("destino_iata"), F.col("icao").alias("destino_icao"))
    av = L.fx.airways.select(F.col("aerovia_id"), F.col("codigo").alias("aerovia"))
    j = (f.withColumn("aerovia_id", F.col("vuelo_id") % 75)
         .join(al, "aerolinea_id", "left").join(an, "aeronave_id", "left")
         .join(ao, "origen_id", "left").join(ad, "destino_id", "left").join(av, "aerovia_id", "left")
         .join(pv, "vuelo_id", "left").join(cv, "vuelo_id", "left"))
    return j.select(
        "vuelo_id", "numero_vuelo", "aerolinea", "codigo_iata", "codigo_icao", "matricula", "tipo_aeronave",
        "estado_aeronave", "aeropuerto_origen", "origen_iata", "origen_icao", "aeropuerto_destino",
        "destino_iata", "destino_icao", "aerovia", "salida_programada", "llegada_programada",
        "salida_real", "llegada_real", "estado", "motivo_desviacion",
        _r(minutes_between("llegada_real", "salida_real")).alias("duracion_real_min"),
        _r(minutes_between("salida_real", "salida_programada")).alias("delay_salida_min"),
        _r(minutes_between("llegada_real", "llegada_programada")).alias("delay_llegada_min"),
        F.coalesce("pasajeros_totales", F.lit(0)).alias("pasajeros_totales"),
        F.coalesce("equipaje_total_piezas", F.lit(0)).cast("bigint").alias("equipaje_total_piezas"),
        F.coalesce("equipaje_total_kg", F.lit(0)).cast("double").alias("equipaje_total_kg"),
        F.coalesce("revenue_pasajeros_usd", F.lit(0)).cast("double").alias("revenue_pasajeros_usd"),
        F.coalesce("carga_total_kg", F.lit(0)).cast("double").alias("carga_total_kg"),
        _r(F.coalesce("carga_total_kg", F.lit(0)) * F.lit(2.5).cast("decimal(2,1)")).alias("carga_revenue_estimado"))


# ---- V2 ---------------------------------------------------------------------
@query
def active_maintenance(L: Layers) -> DataFrame:
    me = L.maintenance.where(F.col("estado").isin("OPEN", "INPROGRESS", "DEFERRED"))
    a = L.fleet.select("aeronave_id", "matricula", F.col("tipo").alias("tipo_aeronave"),
                       F.col("estado").alias("estado_aeronave"))
    mo = L.engines.select("motor_id", F.col("modelo").alias("modelo_motor"), "serial_number",
                          "horas_acumuladas", "ciclos_acumulados")
    tm = L.workshops.select("taller_id", F.col("nombre").alias("taller_nombre"), F.col("tipo").alias("taller_tipo"))
    j = me.join(a, "aeronave_id", "left").join(mo, "motor_id", "left").join(tm, "taller_id", "left")
    end = F.coalesce(F.col("fecha_fin"), F.lit(MAINT_AS_OF).cast("timestamp_ntz"))
    active = F.col("estado").isin("OPEN", "INPROGRESS")
    return _dbl(j.select(
        "evento_id", "aeronave_id", "motor_id", "taller_id", "matricula", "tipo_aeronave", "estado_aeronave",
        "modelo_motor", "serial_number", "horas_acumuladas", "ciclos_acumulados", "taller_nombre", "taller_tipo",
        "tipo_check", "componente", "descripcion", "tecnico_id", "fecha_inicio", "fecha_fin",
        _r(minutes_between(end, "fecha_inicio") / 60).alias("duracion_horas"),
        "costo_usd", "estado",
        active.alias("mantenimiento_activo"),
        ((F.col("estado_aeronave") == "MANTENIMIENTO") & active).alias("aeronave_aog"))
        .orderBy(F.col("fecha_inicio").desc_nulls_last(), "evento_id"))


# ---- V3 ---------------------------------------------------------------------
@query
def notam_status(L: Layers) -> DataFrame:
    n = L.fx.notams
    a = L.fx.airports.select("aeropuerto_id", F.col("nombre").alias("aeropuerto_nombre"), "iata", "icao",
                             "municipality", "iso_country")
    now = F.lit(NOTAM_AS_OF).cast("timestamp_ntz")
    active = now.between(F.col("valido_desde"), F.col("valido_hasta"))
    return (n.join(a, "aeropuerto_id", "left").select(
        "notam_id", "ident", "tipo", "aeropuerto_id", "aeropuerto_nombre", "iata", "icao", "municipality",
        "iso_country", "radio_nm", "altura_min", "valido_desde", "valido_hasta",
        _r(minutes_between("valido_hasta", now) / 60).alias("horas_restantes"),
        F.when(active, "ACTIVO").when(now < F.col("valido_desde"), "PROGRAMADO").otherwise("EXPIRADO").alias("estado_notam"),
        F.coalesce(active, F.lit(False)).alias("activo"))
        .orderBy(F.col("valido_desde").desc_nulls_last(), "notam_id"))


# ---- V4 ---------------------------------------------------------------------
@query
def masked_passengers(L: Layers) -> DataFrame:
    p = L.fx.passengers
    return p.select(
        "pasajero_id",
        F.lit("***MASKED***").alias("documento"), F.lit("***").alias("tipo_doc"),
        F.lit("PASAJERO ANONIMO").alias("nombre"),
        "nacionalidad", "categoria",
        F.floor(F.months_between(F.lit(PAX_AS_OF).cast("date"), F.col("fecha_nacimiento")) / 12)
         .cast("int").alias("edad_aproximada"))


# ---- V6 / V7 ---------------------------------------------------------------------
def latest_position_df(L: Layers) -> DataFrame:
    pos = L.positions.select("posicion_id", "vuelo_id", "timestamp_utc", "lon", "lat", "z_m",
                             "velocidad_nudos", "heading", "fase_vuelo")
    return first_per_key(pos, ["vuelo_id"], [*desc("timestamp_utc", kind="ts"), F.col("posicion_id")])


@query
def latest_position(L: Layers) -> DataFrame:
    v = L.fx.flights.select("vuelo_id", "numero_vuelo", "aeronave_id")
    return latest_position_df(L).join(v, "vuelo_id")


@query
def flight_status_view(L: Layers) -> DataFrame:
    v = L.fx.flights
    al = L.airlines.select("aerolinea_id", F.col("nombre").alias("aerolinea"))
    ao = airport_code("origen", L.fx.airports, "origen_id")
    ad = airport_code("destino", L.fx.airports, "destino_id")
    pos = latest_position_df(L).select("vuelo_id", F.col("timestamp_utc").alias("ultima_actualizacion"),
                                       "lon", "lat", "velocidad_nudos", "fase_vuelo")
    tv = L.crew.select("vuelo_id", "roster_id", "rol", "duty_start", "duty_end")
    j = (v.join(al, "aerolinea_id").join(ao, "origen_id").join(ad, "destino_id")
          .join(pos, "vuelo_id", "left").join(tv, "vuelo_id", "left"))
    return j.select("vuelo_id", "numero_vuelo", "aerolinea", "origen", "destino", "estado",
                    "salida_programada", "llegada_programada", "salida_real", "llegada_real",
                    "ultima_actualizacion", "lon", "lat", "velocidad_nudos", "fase_vuelo",
                    "roster_id", "rol", "duty_start", "duty_end")


# ---- V8 ---------------------------------------------------------------------
@query
def passenger_connections(L: Layers) -> DataFrame:
    p = L.fx.passengers.select("pasajero_id", "nombre")
    pv = L.fx.bookings.select("pv_id", "pasajero_id", "vuelo_id", "clase", "tarifa_usd")
    v = L.fx.flights.select("vuelo_id", "numero_vuelo", "origen_id", "destino_id", "salida_programada",
                            "llegada_programada")
    ao = airport_code("origen", L.fx.airports, "origen_id")
    ad = airport_code("destino", L.fx.airports, "destino_id")
    j = (p.join(pv, "pasajero_id").join(v, "vuelo_id").join(ao, "origen_id").join(ad, "destino_id")
          .select("pasajero_id", "nombre", "pv_id", "vuelo_id", "clase", "tarifa_usd", "numero_vuelo",
                  "origen", "destino", "salida_programada", "llegada_programada"))
    out = lead_by_key(j, "pasajero_id", ["salida_programada", "vuelo_id", "pv_id", "clase", "tarifa_usd"],
                      "numero_vuelo", "siguiente_vuelo")
    return out.select("pasajero_id", "nombre", "pv_id", "numero_vuelo", "origen", "destino",
                      "llegada_programada", "siguiente_vuelo")


# ---- V9 / V10 / V11 / V12 ----------------------------------------------------
@query
def baggage_trace(L: Layers) -> DataFrame:
    v = L.fx.flights.select("vuelo_id", "numero_vuelo", "origen_id", "destino_id")
    ao = airport_code("origen", L.fx.airports, "origen_id")
    ad = airport_code("destino", L.fx.airports, "destino_id")
    return (L.baggage.join(v, "vuelo_id").join(ao, "origen_id").join(ad, "destino_id")
             .select("tag_id", "estado", "ubicacion_actual", "timestamp_ultimo_evento", "numero_vuelo",
                     "origen", "destino"))


@query
def customs_pending(L: Layers) -> DataFrame:
    c = L.cargo.where("tiene_declaracion")
    v = L.fx.flights.select("vuelo_id", "origen_id", "destino_id")
    ao = L.fx.airports.select(F.col("aeropuerto_id").alias("origen_id"), F.col("ident").alias("origen"))
    ad = L.fx.airports.select(F.col("aeropuerto_id").alias("destino_id"), F.col("ident").alias("destino"))
    c = c.withColumn("doc", document("declaracion_aduanera"))
    return (c.join(v, "vuelo_id").join(ao, "origen_id").join(ad, "destino_id").select(
        "awb", "tipo", F.col("peso_kg").cast("double").alias("peso_kg"), "origen", "destino",
        field("doc", "commodity").alias("commodity"),
        field("doc", "customs_value_usd", "decimal(14,2)").cast("double").alias("customs_value_usd"),
        field("doc", "dangerous_goods", "boolean").alias("dangerous_goods")))


@query
def crew_duty_hours(L: Layers) -> DataFrame:
    return L.crew.groupBy("crew_id").agg(
        F.count("vuelo_id").alias("vuelos_asignados"),
        F.sum("horas_vuelo_duty").cast("double").alias("horas_totales_duty"),
        avg_dec("descanso_horas", 2, 4).alias("descanso_promedio"),
        F.bool_and("descanso_minimo_cumple").alias("cumple_regulacion"))


@query
def engine_health(L: Layers) -> DataFrame:
    s = L.sensors
    return s.groupBy("engine_id").agg(
        avg_dec("egt_c", 2, 4).alias("temperatura_promedio"),
        avg_dec("vibration", 3, 4).alias("vibracion_promedio"),
        avg_dec("fuel_flow_kgh", 2, 4).alias("combustible_promedio"),
        F.max("timestamp_utc").alias("ultimo_sensor"),
        F.count("*").alias("total_lecturas"),
        F.count("vibration").alias("lecturas_vibracion"),
        F.when((F.avg("vibration") > 5) | (F.avg("egt_c") > 900), "REQUIERE_INSPECCION")
         .otherwise("OPERACION_NORMAL").alias("estado_predictivo"))


# ---- V13-V18 ------------------------------------------------------------------
def _cargo_by_route_month(L: Layers) -> DataFrame:
    r = L.dim_route.select("ruta_id", "origen_icao", "destino_icao", "mercado")
    t = L.dim_calendar.select("tiempo_id", "anio", "mes")
    return L.fact_cargo.join(r, "ruta_id").join(t, "tiempo_id")


@query
def cargo_demand_by_route(L: Layers) -> DataFrame:
    return _cargo_by_route_month(L).groupBy("origen_icao", "destino_icao", "anio", "mes").agg(
        F.count("*").alias("total_envios"),
        _r(F.sum("cargo_weight_kg")).alias("peso_total_kg"),
        _r(F.sum("cargo_volume_m3")).alias("volumen_total_m3"),
        _r(F.sum("cargo_revenue_usd")).alias("revenue_total_usd"),
        avg_dec("yield_usd_kgkm", 4, 4).alias("promedio_yield"),
        F.sum("perishable_count").alias("carga_perecible"),
        F.sum("dangerous_goods_count").alias("carga_peligrosa"),
        F.sum("customs_hold_count").alias("retenciones_aduana"))


@query
def customs_summary(L: Layers) -> DataFrame:
    return _cargo_by_route_month(L).groupBy("anio", "mes", "origen_icao", "destino_icao", "mercado").agg(
        F.count("*").alias("total_operaciones_carga"),
        _r(F.sum("cargo_weight_kg")).alias("peso_total_kg"),
        _r(F.sum("cargo_revenue_usd")).alias("revenue_total_usd"),
        avg_dec("clearance_time_avg_hours", 2, 4).alias("promedio_despacho_horas"),
        F.sum("customs_hold_count").alias("total_retenciones_aduana"),
        F.sum("perishable_count").alias("mercancia_perecible"),
        F.sum("dangerous_goods_count").alias("mercancia_peligrosa"),
        avg_dec("yield_usd_kgkm", 4, 4).alias("yield_promedio_kgkm"))


@query
def fuel_efficiency_monthly(L: Layers) -> DataFrame:
    da = L.dim_aircraft.select("aeronave_id", F.col("tipo").alias("tipo_aeronave"), "fabricante")
    t = L.dim_calendar.select("tiempo_id", "anio", "mes")
    return (L.fact_fuel.join(da, "aeronave_id").join(t, "tiempo_id")
            .groupBy("tipo_aeronave", "fabricante", "anio", "mes").agg(
                F.count("*").alias("total_operaciones"),
                _r(F.sum("fuel_consumed_kg")).alias("combustible_total_kg"),
                avg_dec("efficiency_kg_km", 4, 4).alias("eficiencia_promedio_kg_km"),
                avg_dec("co2_per_pax_km", 4, 4).alias("co2_promedio_pax_km"),
                avg_dec("alternative_fuel_pct", 2, 4).alias("promedio_saf_pct"),
                _r(F.sum("fuel_cost_total_usd")).alias("costo_total_combustible_usd")))


@query
def safety_summary(L: Layers) -> DataFrame:
    """V15 with the fan-out fixed (T5): each fact is reduced to months first."""
    cal = L.dim_calendar.select("tiempo_id", "anio", "mes", "trimestre")
    months = cal.select("anio", "mes", "trimestre").distinct()
    ym = cal.select("tiempo_id", "anio", "mes")
    hv = (L.fact_flight.join(ym, "tiempo_id").groupBy("anio", "mes").agg(
        F.count("*").alias("total_vuelos"),
        F.count_distinct(F.when(F.col("delay_min") > 120, F.col("vuelo_id"))).alias("incidentes_operacionales")))
    ht = (L.fact_crew.join(ym, "tiempo_id").groupBy("anio", "mes").agg(
        F.sum("fatigue_events").alias("eventos_fatiga"),
        avg_dec("crew_pairing_efficiency_pct", 2, 4).alias("eficiencia_tripulacion_pct")))
    sv = (L.fx.flights.where(F.col("estado").isin("DIVERTED", "CANCEL"))
          .select("vuelo_id", "estado", F.year("salida_programada").alias("anio"),
                  F.month("salida_programada").alias("mes")))
    svm = sv.groupBy("anio", "mes").agg(
        F.count_distinct(F.when(F.col("estado") == "DIVERTED", F.col("vuelo_id"))).alias("vuelos_desviados"),
        F.count_distinct(F.when(F.col("estado") == "CANCEL", F.col("vuelo_id"))).alias("vuelos_cancelados"))
    dev = (L.positions.where(F.col("desviacion_nm") > 50).select("posicion_id", "vuelo_id")
           .join(sv.select("vuelo_id", "anio", "mes"), "vuelo_id")
           .groupBy("anio", "mes").agg(F.count_distinct("posicion_id").alias("desviaciones_ruta_criticas")))
    j = (months.join(hv, ["anio", "mes"], "left").join(ht, ["anio", "mes"], "left")
         .join(svm, ["anio", "mes"], "left").join(dev, ["anio", "mes"], "left"))
    return j.select(
        "anio", "mes", "trimestre",
        F.coalesce("total_vuelos", F.lit(0)).alias("total_vuelos"),
        F.col("eventos_fatiga").cast("bigint").alias("eventos_fatiga"),
        F.coalesce("vuelos_desviados", F.lit(0)).alias("vuelos_desviados"),
        F.coalesce("vuelos_cancelados", F.lit(0)).alias("vuelos_cancelados"),
        F.coalesce("desviaciones_ruta_criticas", F.lit(0)).alias("desviaciones_ruta_criticas"),
        F.coalesce("incidentes_operacionales", F.lit(0)).alias("incidentes_operacionales"),
        "eficiencia_tripulacion_pct")


@query
def otp_by_airport(L: Layers) -> DataFrame:
    t = L.dim_calendar.select("tiempo_id", "anio", "mes")
    r = L.dim_route.select("ruta_id", "origen_icao")
    da = L.dim_airport.select("aeropuerto_id", "iata", F.col("icao").alias("origen_icao"),
                              F.col("nombre").alias("aeropuerto_nombre"), "ciudad", "pais")
    j = L.fact_flight.join(t, "tiempo_id").join(r, "ruta_id").join(da, "origen_icao")
    on_time = F.expr("count(*) filter (where delay_min <= 15)")
    g = j.groupBy("aeropuerto_id", "iata", F.col("origen_icao").alias("icao"), "aeropuerto_nombre", "ciudad",
                  "pais", "anio", "mes").agg(
        F.count("vuelo_id").alias("vuelos_totales"),
        on_time.alias("vuelos_puntuales"),
        F.expr("count(*) filter (where delay_min > 15)").alias("vuelos_demorados"),
        _r(on_time.cast("decimal(20,6)") / F.when(F.count("vuelo_id") != 0, F.count("vuelo_id")) * 100).alias("otp_pct"),
        avg_dec("delay_min", 0, 2).alias("delay_promedio_min"),
        _r(F.sum("total_revenue_usd")).alias("revenue_total_usd"),
        _r(F.sum("co2_emitted_ton")).alias("co2_emitido_ton"))
    return g.orderBy(F.col("anio").desc_nulls_last(), F.col("mes").desc_nulls_last(),
                     F.col("otp_pct").desc_nulls_last(), "aeropuerto_id")


@query
def route_occupancy(L: Layers) -> DataFrame:
    r = L.dim_route.select("ruta_id", "origen_icao", "destino_icao", "tipo_ruta", "mercado")
    t = L.dim_calendar.select("tiempo_id", "anio", "mes")
    j = L.fact_flight.drop("tipo_ruta").join(r, "ruta_id").join(t, "tiempo_id")
    km = F.col("distance_flown_km").cast("decimal(14,2)")
    ask = F.sum(F.col("asientos_ofrecidos") * km)
    rpk = F.sum(F.col("pax_transportados") * km)
    g = j.groupBy("ruta_id", "origen_icao", "destino_icao", "tipo_ruta", "mercado", "anio", "mes").agg(
        F.count("vuelo_id").alias("vuelos_operados"),
        F.sum("asientos_ofrecidos").alias("asientos_ofrecidos"),
        F.sum("asientos_vendidos").alias("asientos_vendidos"),
        F.sum("pax_transportados").alias("pasajeros_transportados"),
        _r(F.sum(km)).alias("distancia_total_km"),
        _r(ask).alias("ask_total"),
        _r(rpk).alias("rpk_total"),
        _r(rpk * 100 / F.when(ask != 0, ask)).alias("load_factor_pct"),
        _r(F.sum("passenger_revenue_usd")).alias("passenger_revenue_usd"),
        _r(F.sum("total_revenue_usd")).alias("total_revenue_usd"),
        _r(F.sum("passenger_revenue_usd") / F.when(rpk != 0, rpk), 4).alias("yield_usd_rpk"))
    return g.orderBy(F.col("anio").desc_nulls_last(), F.col("mes").desc_nulls_last(),
                     F.col("load_factor_pct").desc_nulls_last(), "ruta_id")
