"""Silver -> gold: star-schema dimensions and facts.

Each builder is a pure DataFrame function. Plan shape notes:

* Children of the flight fact (bookings, cargo, fuel) are aggregated by
  ``vuelo_id`` *before* the join (partial + final hash aggregate), so the
  fact join is 1:1 and the aggregate combines map-side under skew.
* Dimensions are joined with plain equi-joins; AQE turns them into
  broadcast joins when the runtime size is under
  ``spark.sql.autoBroadcastJoinThreshold`` and keeps a shuffle join
  otherwise, so no dimension is broadcast unchecked. Only constant-size
  inputs (6 roles, 8 holidays) carry an explicit broadcast hint.
* Random attributes are ``u(key, salt)`` draws, stable under retries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import codes
from contrail.functions.conform import code_map, date_key, json_sum_values, minutes_between
from contrail.functions.det import pick, u
from contrail.functions.geo import sphere_distance_m
from contrail.operators.dedup import asc, desc, first_per_key
from contrail.operators.ids import dense_index

AS_OF = "2026-01-01"          # replaces CURRENT_DATE (trap T11)
ENRICH_BELOW_BOARDED = 50      # K10 cut-off


# ---- K1 calendar ------------------------------------------------------------
def dim_calendar(dates: DataFrame, ts_col: str = "ts") -> DataFrame:
    """Daily calendar spanning every fact date (the range is data-driven, T15).

    Only min and max reach the single generating row; the calendar grows
    with the covered time span, not with the data volume.
    """
    rng = dates.agg(F.min(F.to_date(ts_col)).alias("d0"), F.max(F.to_date(ts_col)).alias("d1"))
    d = rng.select(F.explode(F.sequence("d0", "d1", F.expr("interval 1 day"))).alias("fecha"))
    md = F.date_format("fecha", "MM-dd")
    dow = F.expr("extract(DAYOFWEEK_ISO from fecha)").cast("int")
    mes = F.month("fecha")
    return d.select(
        date_key("fecha").alias("tiempo_id"),
        "fecha",
        F.year("fecha").alias("anio"),
        F.quarter("fecha").alias("trimestre"),
        mes.alias("mes"),
        F.dayofmonth("fecha").alias("dia"),
        dow.alias("dia_semana"),
        F.date_format("fecha", "EEEE").alias("nombre_dia"),
        dow.isin(6, 7).alias("es_fin_semana"),
        md.isin(*[h[0] for h in codes.HOLIDAYS]).alias("es_festivo"),
        code_map(md, codes.HOLIDAYS).alias("festivo_nombre"),
        F.weekofyear("fecha").alias("semana_anio"),
        F.when(mes.isin(*codes.SEASON_HIGH_MONTHS), "ALTA")
         .when(mes.isin(*codes.SEASON_MID_MONTHS), "MEDIA").otherwise("BAJA").alias("temporada"),
    )


# ---- K2 airports ------------------------------------------------------------
def dim_airport(airports: DataFrame, flights: DataFrame) -> DataFrame:
    """One row per normalised ICAO; candidates carry departure or arrival counts."""
    dep = flights.groupBy(F.col("origen_id").alias("aeropuerto_id")).agg(F.count("*").alias("cnt"))
    arr = flights.groupBy(F.col("destino_id").alias("aeropuerto_id")).agg(F.count("*").alias("cnt"))
    counts = dep.unionByName(arr)
    icao_norm = F.substring(F.coalesce(_nullif_blank("icao"), _nullif_blank("ident")), 1, 4)
    iata_norm = _nullif_blank(F.substring("iata", 1, 3))
    cand = (airports.join(counts, "aeropuerto_id")
            .where(F.col("latitude_deg").isNotNull() & F.col("longitude_deg").isNotNull()
                   & F.col("iso_country").isNotNull()
                   & F.coalesce(_nullif_blank("icao"), _nullif_blank("ident")).isNotNull())
            .select(
                "aeropuerto_id",
                icao_norm.alias("icao"),
                iata_norm.alias("iata"),
                "nombre",
                F.col("municipality").alias("ciudad"),
                F.col("iso_country").alias("pais"),
                code_map("continent", codes.CONTINENT_REGION, "NORTEAMERICA").alias("region"),
                code_map("iso_country", codes.COUNTRY_TZ, "UTC").alias("zona_horaria"),
                F.when(F.col("cnt") >= 100, "HUB").when(F.col("cnt") >= 20, "FOCUS_CITY")
                 .otherwise("SPOKE").alias("categoria"),
                F.col("latitude_deg").alias("latitud"),
                F.col("longitude_deg").alias("longitud"),
                F.col("cnt").alias("volumen")))
    best = first_per_key(cand, ["icao"],
                         [F.col("iata").isNull(), *desc("volumen"), F.col("aeropuerto_id")])
    return best.drop("volumen")


def _nullif_blank(c):
    t = F.trim(c if not isinstance(c, str) else F.col(c))
    return F.when(t == "", F.lit(None)).otherwise(t)


# ---- K3 aircraft ------------------------------------------------------------
def manufacturer(tipo) -> F.Column:
    t = F.upper(tipo)
    return (F.when(t.like("AIRBUS%") | t.like("A3%") | t.like("A2%"), "AIRBUS")
             .when(t.like("B%") | t.like("BOEING%"), "BOEING")
             .when(t.like("E%") | t.like("EMB%"), "EMBRAER")
             .otherwise("BOEING"))


def dim_aircraft(aircraft: DataFrame, as_of: str = AS_OF) -> DataFrame:
    a = aircraft.where(F.col("matricula").isNotNull() & F.col("configuracion_asientos").isNotNull()
                       & F.col("fecha_alta").isNotNull())
    return a.select(
        "aeronave_id",
        F.substring("matricula", 1, 10).alias("matricula"),
        F.substring("tipo", 1, 10).alias("tipo"),
        manufacturer(F.col("tipo")).alias("fabricante"),
        F.round(F.datediff(F.lit(as_of).cast("date"), F.col("fecha_alta")).cast("decimal(10,0)")
                / F.lit(365.25).cast("decimal(5,2)"), 1).cast("double").alias("edad_anios"),
        json_sum_values("configuracion_asientos").alias("configuracion_total_asientos"),
        "estado",
    )


# ---- K4 routes --------------------------------------------------------------
def dim_route(flights: DataFrame, dim_ap: DataFrame) -> DataFrame:
    pairs = (flights.where(F.col("origen_id").isNotNull() & F.col("destino_id").isNotNull())
             .select("origen_id", "destino_id").distinct())
    o = dim_ap.select(F.col("aeropuerto_id").alias("origen_id"), F.col("icao").alias("origen_icao"),
                      F.col("latitud").alias("lat_o"), F.col("longitud").alias("lon_o"),
                      F.col("pais").alias("pais_o"), F.col("region").alias("reg_o"))
    d = dim_ap.select(F.col("aeropuerto_id").alias("destino_id"), F.col("icao").alias("destino_icao"),
                      F.col("latitud").alias("lat_d"), F.col("longitud").alias("lon_d"),
                      F.col("pais").alias("pais_d"), F.col("region").alias("reg_d"))
    r = pairs.join(o, "origen_id").join(d, "destino_id")
    dist = sphere_distance_m("lat_o", "lon_o", "lat_d", "lon_d")
    km = dist / 1000
    base = r.select(
        "origen_icao", "destino_icao",
        F.round(dist / 1852, 2).alias("distancia_nm"),
        F.round(km, 2).alias("distancia_km"),
        (F.floor(km / 800 * 60) + 30).cast("int").alias("duracion_estimada_min"),
        F.when(km < 1500, "CORTO_HAUL").when(km < 4000, "MEDIO_HAUL").when(km < 8000, "LARGO_HAUL")
         .otherwise("ULTRA_LARGO").alias("tipo_ruta"),
        F.when(F.col("pais_o") == F.col("pais_d"), "DOMESTICO")
         .when(F.col("reg_o") == F.col("reg_d"), "REGIONAL").otherwise("INTERCONTINENTAL").alias("mercado"),
    )
    return dense_index(base, ["origen_icao", "destino_icao"], "ruta_id").withColumn(
        "ruta_id", F.col("ruta_id").cast("int"))


# ---- K5 passenger segment ---------------------------------------------------
def dim_passenger_segment(passengers: DataFrame) -> DataFrame:
    k = F.col("pasajero_id")
    cat = F.upper(F.col("categoria"))
    base_spread = (F.when(cat.isin("FIRST", "PLATINUM", "DIAMOND"), F.lit(10000) + u(k, "val") * 40000)
                    .when(cat.isin("GOLD", "EXEC"), F.lit(5000) + u(k, "val") * 15000)
                    .when(cat == "SILVER", F.lit(2000) + u(k, "val") * 5000)
                    .otherwise(F.lit(500) + u(k, "val") * 2000))
    return passengers.select(
        "pasajero_id",
        F.substring(F.coalesce(F.col("programa_fidelidad") if "programa_fidelidad" in passengers.columns
                               else F.lit(None).cast("string"), F.lit("NONE")), 1, 10).alias("categoria_fidelidad"),
        F.when(cat.isin(*codes.BUSINESS_CATEGORIES), "BUSINESS")
         .when(u(k, "mice") < 0.10, "MICE").when(u(k, "vfr") < 0.25, "VFR").otherwise("LEISURE").alias("segmento"),
        F.when(cat.isin("PLATINUM", "DIAMOND"), "ALTA").when(cat.isin("GOLD", "SILVER"), "MEDIA")
         .otherwise("BAJA").alias("frecuencia_anual"),
        F.round(base_spread.cast("decimal(18,6)"), 2).cast("double").alias("valor_estimado_usd"),
    )


# ---- K6 crew roles ----------------------------------------------------------
def dim_crew_role(spark) -> DataFrame:
    return spark.createDataFrame(
        codes.CREW_ROLE_DIM,
        "rol_id int, rol string, tipo string, minimo_descanso_horas int, maximo_duty_horas int")


# ---- K7 fuel backfill -------------------------------------------------------
def fuel_backfill(flights: DataFrame, fuel: DataFrame) -> DataFrame:
    """Synthetic load 45 min before departure for flights without any fuel row.

    Cost follows rule M6 (litres x unit price), which overrides the
    generator's independent cost in the reference.
    """
    missing = flights.where(F.col("salida_programada").isNotNull()).join(
        fuel.select("vuelo_id"), "vuelo_id", "left_anti")
    k = F.col("vuelo_id")
    litros = (F.lit(3000) + u(k, "bf_lit") * 85000).cast("decimal(12,2)")
    dens = (F.lit(0.78) + u(k, "bf_den") * 0.05).cast("decimal(6,3)")
    precio = (F.lit(0.75) + u(k, "bf_pre") * 0.20).cast("decimal(8,4)")
    # mass follows litres x density (the reference drew it independently,
    # which can break rule M6; not reproduced)
    masa = (litros * dens).cast("decimal(14,2)")
    return missing.select(
        k, F.col("origen_id").alias("aeropuerto_id"),
        litros.alias("litros"), dens.alias("densidad_kgl"), masa.alias("masa_kg"),
        precio.alias("precio_litro_usd"),
        (litros * precio).cast("decimal(14,2)").alias("costo_total_usd"),
        F.timestamp_add("MINUTE", F.lit(-45), F.col("salida_programada")).alias("timestamp_carga"))


# ---- K8/K9 flight fact ------------------------------------------------------
def route_lookup(flights: DataFrame, dim_ap: DataFrame, dim_rt: DataFrame) -> DataFrame:
    """Flight -> route via the airports' ICAO on both ends (C14)."""
    o = dim_ap.select(F.col("aeropuerto_id").alias("origen_id"), F.col("icao").alias("origen_icao"))
    d = dim_ap.select(F.col("aeropuerto_id").alias("destino_id"), F.col("icao").alias("destino_icao"))
    return (flights.join(o, "origen_id").join(d, "destino_id")
                   .join(dim_rt, ["origen_icao", "destino_icao"]))


def flight_routes(flights: DataFrame, dim_ap: DataFrame, dim_rt: DataFrame, dim_cal: DataFrame) -> DataFrame:
    """Each scheduled flight with its route and calendar day.

    Shared by the flight, cargo and fuel facts: written once, it turns each
    fact into one N:1 join on ``vuelo_id`` instead of four lookups apiece.
    """
    f = flights.where(F.col("salida_programada").isNotNull())
    return (route_lookup(f, dim_ap, dim_rt).withColumn("tiempo_id", date_key("salida_programada"))
            .join(dim_cal.select("tiempo_id"), "tiempo_id"))


def fact_flight(flights, aircraft, dim_ap, dim_rt, dim_ac, dim_cal, bookings, cargo, fuel,
                year: int | None = None, routes: DataFrame | None = None) -> DataFrame:
    if routes is None:
        routes = flight_routes(flights, dim_ap, dim_rt, dim_cal)
    f = routes.where(F.col("llegada_programada").isNotNull())
    if year is not None:
        f = f.where(F.year("salida_programada") == year)
    pv = bookings.groupBy("vuelo_id").agg(
        F.count("*").alias("pv_sold"),
        F.sum(F.when(F.col("estado") == "BOARDED", 1).otherwise(0)).alias("pv_boarded"),
        F.sum("tarifa_usd").alias("pv_revenue"))
    cg = cargo.groupBy("vuelo_id").agg(F.sum(F.col("peso_kg") * F.lit(2.5).cast("decimal(2,1)")).alias("cg_revenue"))
    cb = fuel.groupBy("vuelo_id").agg(F.sum("masa_kg").alias("cb_kg"), F.sum("costo_total_usd").alias("cb_cost"))
    j = (f.join(aircraft.select("aeronave_id", "configuracion_asientos"), "aeronave_id")
         .join(dim_ac.select("aeronave_id"), "aeronave_id")
         .join(pv, "vuelo_id", "left").join(cg, "vuelo_id", "left").join(cb, "vuelo_id", "left"))
    k = F.col("vuelo_id")
    delay_raw = F.coalesce(minutes_between("salida_real", "salida_programada"), F.lit(0.0))
    block = minutes_between("llegada_programada", "salida_programada")
    fuel_kg = F.coalesce(F.col("cb_kg"), F.lit(0).cast("decimal(14,3)"))
    pax_rev = F.coalesce(F.col("pv_revenue"), F.lit(0).cast("decimal(22,2)"))
    cargo_rev = F.coalesce(F.col("cg_revenue"), F.lit(0).cast("decimal(22,3)"))
    tr = F.col("tipo_ruta")
    alt = (F.when(tr == "CORTO_HAUL", F.lit(28000) + F.floor(u(k, "alt") * 5000))
            .when(tr == "MEDIO_HAUL", F.lit(33000) + F.floor(u(k, "alt") * 5000))
            .when(tr == "LARGO_HAUL", F.lit(37000) + F.floor(u(k, "alt") * 4000))
            .otherwise(F.lit(39000) + F.floor(u(k, "alt") * 3000)))
    mot = F.upper(F.col("motivo_desviacion"))
    return j.select(
        "vuelo_id", "tiempo_id", "aerolinea_id", "ruta_id", "aeronave_id",
        F.lit(1).alias("vuelos_totales"),
        F.coalesce(json_sum_values("configuracion_asientos"), F.lit(180).cast("bigint")).alias("asientos_ofrecidos"),
        F.coalesce(F.col("pv_sold"), F.lit(0)).cast("bigint").alias("asientos_vendidos"),
        F.coalesce(F.col("pv_boarded"), F.lit(0)).cast("bigint").alias("pax_transportados"),
        F.coalesce(F.col("pv_sold") - F.col("pv_boarded"), F.lit(0)).cast("bigint").alias("pax_no_show"),
        cargo_rev.cast("decimal(18,2)").alias("cargo_revenue_usd"),
        pax_rev.cast("decimal(18,2)").alias("passenger_revenue_usd"),
        F.coalesce(F.col("cb_cost"), F.lit(0)).cast("decimal(18,2)").alias("fuel_cost_usd"),
        (F.coalesce(F.col("cb_cost"), F.lit(0)).cast("decimal(18,2)")
         + (F.lit(5000) + u(k, "opc") * 15000).cast("decimal(10,2)")).cast("decimal(18,2)").alias("operating_cost_usd"),
        F.round(block).cast("int").alias("block_time_min"),
        (F.round(block).cast("int") - 30).alias("airborne_time_min"),
        F.lit(30).alias("taxi_time_min"),
        F.greatest(F.round(delay_raw).cast("int"), F.lit(0)).alias("delay_min"),
        F.when(F.col("motivo_desviacion").isNotNull(),
               F.when(mot == "WEATHER", "WEATHER").when(mot == "TECHNICAL", "TECHNICAL").otherwise("GROUND"))
         .when(delay_raw > 15, pick(["ATC", "WEATHER", "TECHNICAL", "CREW", "GROUND", "PASSENGER"], k, "dcode"))
         .alias("delay_code"),
        fuel_kg.cast("decimal(18,3)").alias("fuel_consumed_kg"),
        "distancia_nm", "distancia_km", "tipo_ruta",
        F.col("distancia_nm").alias("distance_flown_nm"),
        F.col("distancia_km").alias("distance_flown_km"),
        alt.cast("int").alias("altitude_max_ft"),
        (F.lit(420) + u(k, "spd") * 60).cast("decimal(8,2)").alias("speed_avg_kts"),
        (pax_rev + cargo_rev).cast("decimal(18,2)").alias("total_revenue_usd"),
        F.when(F.col("cb_kg").isNull(), F.lit(0).cast("decimal(18,2)"))
         .otherwise(F.round(fuel_kg * F.lit(3.16).cast("decimal(3,2)") / 1000, 2)).cast("decimal(18,2)")
         .alias("co2_emitted_ton"),
        F.col("estado"),
        "salida_programada",
    ).drop("distancia_nm", "distancia_km")


def fact_flight_enrich(fact: DataFrame, below: int = ENRICH_BELOW_BOARDED) -> DataFrame:
    """Rows with few boarded passengers get synthetic sales (A13 + u).

    Each column draws its own factors, as in the reference (so boarded
    can exceed sold). Revenue and CO2 are re-derived afterwards (M7/M8).
    """
    k = F.col("vuelo_id")
    seats = F.col("asientos_ofrecidos")
    cond = F.col("_enrich")
    km = F.col("distance_flown_km")
    fare = (F.when(km < 1500, F.lit(200) + u(k, "en_f") * 250)
             .when(km < 4000, F.lit(400) + u(k, "en_f") * 400)
             .when(km < 8000, F.lit(700) + u(k, "en_f") * 600)
             .otherwise(F.lit(1200) + u(k, "en_f") * 800))
    sold = F.floor(seats * (F.lit(0.75) + u(k, "en_s") * 0.20))
    out = (fact.withColumn("_enrich", F.col("pax_transportados") < below)
           .withColumn("asientos_vendidos", F.when(cond, sold.cast("bigint")).otherwise(F.col("asientos_vendidos")))
           .withColumn("pax_transportados", F.when(cond, F.floor(
               seats * (F.lit(0.75) + u(k, "en_b1") * 0.20) * (F.lit(0.95) + u(k, "en_b2") * 0.04)).cast("bigint"))
               .otherwise(F.col("pax_transportados")))
           .withColumn("pax_no_show", F.when(cond, F.floor(
               seats * (F.lit(0.75) + u(k, "en_n1") * 0.20) * (F.lit(0.01) + u(k, "en_n2") * 0.04)).cast("bigint"))
               .otherwise(F.col("pax_no_show")))
           .withColumn("passenger_revenue_usd", F.when(cond, (F.floor(
               seats * (F.lit(0.75) + u(k, "en_r") * 0.20)) * fare).cast("decimal(18,2)"))
               .otherwise(F.col("passenger_revenue_usd")))
           .withColumn("total_revenue_usd", (F.col("passenger_revenue_usd") + F.col("cargo_revenue_usd")).cast("decimal(18,2)"))
           .drop("_enrich"))
    return out


# ---- K11/K12 passenger fact ---------------------------------------------------
def fact_passenger(bookings: DataFrame, fact: DataFrame, seg: DataFrame) -> DataFrame:
    """Passenger x flight, joined on the flight id (T6), not on (date, aircraft)."""
    hv = fact.select("vuelo_id", "tiempo_id", "ruta_id", "distance_flown_km",
                     "pax_transportados", "asientos_ofrecidos")
    j = (bookings.where(F.col("pasajero_id").isNotNull())
         .join(hv, "vuelo_id").join(seg.select("pasajero_id"), "pasajero_id"))
    k = F.col("pv_id")
    km = F.col("distance_flown_km")
    return j.select(
        "pv_id", "vuelo_id", "tiempo_id", "ruta_id", "pasajero_id",
        F.lit(1).alias("pax_count"),
        F.round(km, 2).alias("revenue_pax_km"),
        F.round(F.col("tarifa_usd").cast("double") / F.when(km != 0, km), 4).alias("yield_usd_rpk"),
        F.least(F.round(F.col("pax_transportados").cast("decimal(20,4)") * 100
                        / F.when(F.col("asientos_ofrecidos") != 0, F.col("asientos_ofrecidos")), 2),
                F.lit(100).cast("decimal(5,2)")).cast("double").alias("load_factor_pct"),
        F.coalesce(F.col("equipaje_piezas"), (F.floor(u(k, "bc") * 2) + 1).cast("int")).alias("baggage_count"),
        F.coalesce(F.col("peso_equipaje_kg"), (F.lit(10) + u(k, "bw") * 20).cast("decimal(8,2)")).cast("double").alias("baggage_weight_kg"),
        F.when(u(k, "lost") < 0.005, 1).otherwise(0).alias("baggage_lost_count"),
        F.when(u(k, "upg") < 0.03, 1).otherwise(0).alias("upgrade_count"),
        F.when(u(k, "dng") < 0.01, 1).otherwise(0).alias("downgrade_count"),
        F.when(u(k, "ast") < 0.05, 1).otherwise(0).alias("special_assistance_count"),
    )


def fact_passenger_yield_fill(fp: DataFrame) -> DataFrame:
    k = F.col("pv_id")
    rpk = F.col("revenue_pax_km")
    fare = (F.when(rpk < 1500, F.lit(200) + u(k, "yf") * 250)
             .when(rpk < 4000, F.lit(400) + u(k, "yf") * 400)
             .when(rpk < 8000, F.lit(700) + u(k, "yf") * 600)
             .otherwise(F.lit(1200) + u(k, "yf") * 800))
    cond = F.col("yield_usd_rpk").isNull() & (rpk > 0)
    return fp.withColumn("yield_usd_rpk", F.when(cond, F.round(fare / rpk, 4)).otherwise(F.col("yield_usd_rpk")))


# ---- K13 cargo fact -----------------------------------------------------------
def fact_cargo(cargo: DataFrame, flights: DataFrame, dim_ap, dim_rt, dim_cal,
               routes: DataFrame | None = None) -> DataFrame:
    if routes is None:
        routes = flight_routes(flights, dim_ap, dim_rt, dim_cal)
    j = (routes.select("vuelo_id", "tiempo_id", "ruta_id", "distancia_km")
         .join(cargo.where(F.col("peso_kg") > 0), "vuelo_id"))
    t = F.col("tipo")
    row = F.concat_ws("|", "awb", "vuelo_id")
    rev_rate = (F.when(t == "GENERAL", F.lit(2.0) + u(row, "cr") * 1.5)
                 .when(t == "PERECIBLE", F.lit(3.5) + u(row, "cr") * 2.0)
                 .when(t == "PELIGROSA", F.lit(5.0) + u(row, "cr") * 3.0)
                 .when(t == "VALORADA", F.lit(8.0) + u(row, "cr") * 5.0)
                 .when(t == "ANIMALES", F.lit(6.0) + u(row, "cr") * 3.0)
                 .otherwise(F.lit(2.44)))
    yld_rate = code_map(t, [(a, b) for a, b in codes.CARGO_YIELD_RATE], codes.CARGO_YIELD_DEFAULT).cast("decimal(6,2)")

    def cnt(tp):
        return F.count_if(t == tp).cast("int")

    g = j.groupBy("tiempo_id", "ruta_id", "distancia_km").agg(
        F.sum("peso_kg").alias("w"), F.sum("volumen_m3").alias("v"),
        F.sum((F.col("peso_kg") * rev_rate).cast("decimal(18,4)")).alias("rev"),
        F.sum(F.col("peso_kg") * yld_rate).alias("yw"),
        *[cnt(x).alias(f"n_{x.lower()}") for x in codes.CARGO_TYPES])
    key = F.concat_ws("|", "tiempo_id", "ruta_id")
    return g.select(
        "tiempo_id", "ruta_id",
        F.round("w", 2).cast("double").alias("cargo_weight_kg"),
        F.round("v", 2).cast("double").alias("cargo_volume_m3"),
        F.round("rev", 2).cast("double").alias("cargo_revenue_usd"),
        F.round(F.col("yw").cast("double") / F.when((F.col("w") * F.col("distancia_km")) != 0,
                                                     F.col("w").cast("double") * F.col("distancia_km")), 4)
         .alias("yield_usd_kgkm"),
        F.to_json(F.struct(*[F.col(f"n_{x.lower()}").alias(x) for x in codes.CARGO_TYPES],
                           F.round("w", 2).alias("TOTAL_KG"))).alias("cargo_type_breakdown"),
        *[F.col(f"n_{x.lower()}").alias(f"count_{x.lower()}") for x in codes.CARGO_TYPES],
        F.col("n_perecible").alias("perishable_count"),
        F.col("n_peligrosa").alias("dangerous_goods_count"),
        F.when(u(key, "hold") < 0.05, 1).otherwise(0).alias("customs_hold_count"),
        F.round(F.lit(0.5) + u(key, "clr") * 2.5, 2).alias("clearance_time_avg_hours"),
    )


# ---- K14 fuel fact ------------------------------------------------------------
def fact_fuel(fuel: DataFrame, flights: DataFrame, dim_ap, dim_ac, dim_rt, dim_cal, fact_fl,
              routes: DataFrame | None = None) -> DataFrame:
    if routes is None:
        routes = flight_routes(flights, dim_ap, dim_rt, dim_cal)
    j = (routes.select("vuelo_id", "origen_id", "aeronave_id", "tiempo_id", "ruta_id", "distancia_km")
         .join(dim_ac.select("aeronave_id"), "aeronave_id")
         .join(fuel.where((F.col("masa_kg") > 0) & (F.col("costo_total_usd") > 0))
                   .select("fuel_id", "vuelo_id", "masa_kg", "costo_total_usd"), "vuelo_id"))
    # C20: (date, aircraft, route) meets every flight of the day on that route; the load's own flight cannot fan out
    j = j.join(fact_fl.select("vuelo_id", F.col("pax_transportados").alias("hv_pax")), "vuelo_id", "left")
    k = F.col("fuel_id")
    km = F.col("distancia_km")
    masa = F.col("masa_kg")
    return j.select(
        "fuel_id", "vuelo_id", "tiempo_id", F.col("origen_id").alias("aeropuerto_id"), "aeronave_id", "ruta_id",
        F.round(masa, 2).cast("double").alias("fuel_uplift_kg"),
        F.round((masa * (F.lit(0.92) + u(k, "cons") * 0.06)).cast("decimal(18,4)"), 2).cast("double").alias("fuel_consumed_kg"),
        F.round(F.col("costo_total_usd") / F.when(masa != 0, masa), 4).cast("double").alias("fuel_price_avg_usd_kg"),
        F.round("costo_total_usd", 2).cast("double").alias("fuel_cost_total_usd"),
        F.least(F.round(masa.cast("double") / F.when(km != 0, km), 4), F.lit(99.9999)).alias("efficiency_kg_km"),
        F.round(F.lit(-5) + u(k, "var") * 10, 2).alias("efficiency_variation_pct"),
        F.least(F.round(masa.cast("double") * 3.16
                        / F.when((F.greatest(F.coalesce(F.col("hv_pax"), F.lit(150)), F.lit(100)) * km) != 0,
                                 F.greatest(F.coalesce(F.col("hv_pax"), F.lit(150)), F.lit(100)) * km), 4),
                F.lit(99.9999)).alias("co2_per_pax_km"),
        F.round(u(k, "saf") * 3, 2).alias("alternative_fuel_pct"),
    )


# ---- K15 maintenance fact -------------------------------------------------------
def fact_maintenance(maint: DataFrame, dim_ac: DataFrame, dim_cal: DataFrame) -> DataFrame:
    m = (maint.where(F.col("aeronave_id").isNotNull() & F.col("fecha_inicio").isNotNull()
                     & F.col("fecha_fin").isNotNull() & F.col("costo_usd").isNotNull())
         .join(dim_ac.select("aeronave_id"), "aeronave_id")
         .withColumn("tiempo_id", date_key("fecha_inicio"))
         .join(dim_cal.select("tiempo_id"), "tiempo_id"))
    k = F.col("evento_id")
    c = F.col("tipo_check")
    mh = (F.when(c == "A", F.lit(40) + u(k, "mh") * 60).when(c == "B", F.lit(100) + u(k, "mh") * 200)
           .when(c == "C", F.lit(300) + u(k, "mh") * 500).when(c == "D", F.lit(800) + u(k, "mh") * 400)
           .when(c == "LINE", F.lit(2) + u(k, "mh") * 8).otherwise(F.lit(10) + u(k, "mh") * 30))
    delay = (F.when(c.isin("C", "D"), F.floor(F.lit(60) + u(k, "dl") * 240))
              .when(c == "B", F.floor(F.lit(15) + u(k, "dl") * 90))
              .when(c == "A", F.floor(u(k, "dl") * 60))
              .when(u(k, "dl_line") < 0.10, F.floor(F.lit(5) + u(k, "dl") * 30))
              .otherwise(F.lit(0)))
    defer = (F.when(c.isin("C", "D"), F.floor(u(k, "df") * 4)).when(c == "B", F.floor(u(k, "df") * 2))
              .when(u(k, "df_o") < 0.05, F.lit(1)).otherwise(F.lit(0)))
    st = F.upper(F.col("estado"))
    comp = (F.when(st == "CLOSED", F.floor(F.lit(1) + u(k, "cc") * 3))
             .when(st == "INPROGRESS", F.floor(u(k, "cc") * 2)).otherwise(F.lit(0)))
    hours = (F.unix_seconds(F.col("fecha_fin").cast("timestamp")) - F.unix_seconds(F.col("fecha_inicio").cast("timestamp"))) / 3600
    return m.select(
        "evento_id", "tiempo_id", "aeronave_id", "tipo_check",
        F.lit(1).alias("events_count"),
        F.least(F.round(mh, 2), F.lit(9999.99)).alias("man_hours"),
        F.round((F.col("costo_usd") * (F.lit(0.50) + u(k, "lab") * 0.20)).cast("decimal(18,4)"), 2).cast("double").alias("cost_labor_usd"),
        F.round((F.col("costo_usd") * (F.lit(0.30) + u(k, "par") * 0.20)).cast("decimal(18,4)"), 2).cast("double").alias("cost_parts_usd"),
        F.round("costo_usd", 2).cast("double").alias("cost_total_usd"),
        F.least(F.round(hours, 2), F.lit(9999.99)).alias("aog_hours"),
        delay.cast("int").alias("delay_caused_min"),
        defer.cast("int").alias("deferrals_count"),
        comp.cast("int").alias("component_changes_count"),
    )


# ---- K16 crew fact --------------------------------------------------------------
def fact_crew(crew: DataFrame, flights: DataFrame, roles: DataFrame, dim_cal: DataFrame) -> DataFrame:
    c = (crew.where(F.col("vuelo_id").isNotNull() & F.col("horas_vuelo_duty").isNotNull()
                    & F.col("descanso_horas").isNotNull())
         .join(flights.where(F.col("salida_programada").isNotNull()).select("vuelo_id", "salida_programada"), "vuelo_id")
         .withColumn("rol_u", F.upper("rol"))
         .join(F.broadcast(roles.select(F.col("rol").alias("rol_u"), "rol_id")), "rol_u")
         .withColumn("tiempo_id", date_key("salida_programada"))
         .join(dim_cal.select("tiempo_id"), "tiempo_id"))
    r = F.col("roster_id")
    g = c.groupBy("tiempo_id", "rol_id", "rol").agg(
        F.count("*").cast("int").alias("crew_count"),
        F.sum("horas_vuelo_duty").alias("duty"),
        F.sum("descanso_horas").alias("rest"),
        F.sum(F.when(F.col("descanso_horas") < F.col("descanso_minimo_requerido"), 1)
               .when(u(r, "fat") < 0.02, 1).otherwise(0)).cast("int").alias("fatigue_events"),
        F.sum(F.when(F.col("descanso_minimo_cumple"), 1).otherwise(0)).alias("ok"))
    key = F.concat_ws("|", "tiempo_id", "rol_id", "rol")
    rol = F.upper(F.col("rol"))
    pd = F.lit(12) + u(key, "pd") * 6
    for name, base, spread in codes.PER_DIEM:
        pd = F.when(rol == name, F.lit(base) + u(key, "pd") * spread).otherwise(pd)
    duty = F.col("duty").cast("double")
    return g.select(
        "tiempo_id", "rol_id", "rol", "crew_count",
        F.least(F.round("duty", 2).cast("double"), F.lit(9999.99)).alias("duty_hours"),
        F.least(F.round(duty * (F.lit(0.70) + u(key, "fh") * 0.15), 2), F.lit(9999.99)).alias("flight_hours"),
        F.least(F.round("rest", 2).cast("double"), F.lit(9999.99)).alias("layover_hours"),
        F.round(duty * pd, 2).alias("per_diem_cost_usd"),
        F.least(F.round(duty * (F.lit(0.05) + u(key, "tr") * 0.05), 2), F.lit(9999.99)).alias("training_hours"),
        "fatigue_events",
        F.least(F.round(F.col("ok").cast("decimal(20,4)") * 100 / F.col("crew_count"), 2),
                F.lit(100).cast("decimal(5,2)")).cast("double").alias("crew_pairing_efficiency_pct"),
    )
