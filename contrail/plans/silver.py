"""Bronze -> silver cleaning pipelines.

Inputs are the bronze-shaped fixture views; outputs are typed silver
DataFrames. Keyed deduplication uses ``first_per_key`` (grouped
``min_by``), which combines map-side and tolerates hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import codes
from contrail.functions.conform import blank_to_null, code_map, flight_phase, not_blank, plus_hours
from contrail.functions.det import pick, u
from contrail.functions.jsondoc import document, field
from contrail.operators.dedup import asc, desc, first_per_key, one_per_seldom_key, with_parent
from contrail.operators.ids import dense_index

# ---- fixed values ------------------------------------------------------------
# full baggage event -> state map (unknown or null -> CHECKED)
BAG_STATES = [("CHECKIN", "CHECKED"), ("LOAD", "LOADED"), ("LOADED", "LOADED"),
              ("TRANSFER", "TRANSFER"), ("UNLOAD", "UNLOADED"), ("UNLOADED", "UNLOADED"),
              ("DELIVERED", "DELIVERED"), ("LOST", "LOST")]
# crew role spellings -> role (unknown or null -> FA)
CREW_ROLES = [("CAPTAIN", "CAPTAIN"), ("FIRST_OFFICER", "FO"), ("FO", "FO"),
              ("RELIEF_PILOT", "RELIEF_CAPTAIN"), ("RELIEF_CAPTAIN", "RELIEF_CAPTAIN"),
              ("PURSER", "PURSER"), ("CABIN_CREW", "FA"), ("FA", "FA"), ("LOADMASTER", "LOADMASTER")]
# maintenance cost base + spread by action (else 500)
ACTION_COST = [("CLEANING", 200, 1000), ("TEST", 500, 2000), ("INSPECTION", 1000, 5000),
               ("REPAIR", 3000, 15000), ("REPLACEMENT", 8000, 40000), ("OVERHAUL", 30000, 100000)]
# inline aircraft inserted when absent: registration, type, seat map
INLINE_AIRCRAFT = [
    ("TI-BGU", "B737-800", '{"business":16,"economy":150}'),
    ("F-GZND", "Airbus A330", '{"business":24,"economy":220}'),
    ("HP-1823CMP", "B737-800", '{"business":16,"economy":150}'),
    ("N123AA", "B787-9", '{"business":30,"economy":260}'),
    ("N456DL", "Airbus A320", '{"economy":180}'),
    ("EC-MXA", "Airbus A320", '{"economy":180}'),
]
# MRO workshops: name, IATA code, type, capacity, certifications
WORKSHOPS = [
    ("MRO Bogotá", "BOG", "HANGAR", 8, ["EASA-145", "FAA-145"]),
    ("MRO Los Angeles", "LAX", "HANGAR", 12, ["FAA-145", "TCCA"]),
    ("MRO Madrid", "MAD", "ENGINE", 6, ["EASA-145", "EASA-21"]),
    ("MRO Miami", "MIA", "LINE", 20, ["FAA-145"]),
    ("MRO Panamá", "PTY", "COMPONENT", 4, ["EASA-145", "DGAC-PA"]),
    ("MRO San José", "SJO", "LINE", 10, ["DGAC-CR", "FAA-145"]),
]
WAYPOINT_TYPES = ["VOR", "VOR-DME", "DME", "NDB", "NDB-DME", "TACAN", "INT"]
# ---- end of fixed values -------------------------------------------------------


# J1 ---------------------------------------------------------------------------
def clean_airlines(flights: DataFrame) -> DataFrame:
    cs = F.upper(F.trim("numero_vuelo"))
    base = flights.where(not_blank("numero_vuelo")).select(
        F.substring(cs, 1, 2).alias("codigo_iata"), F.substring(cs, 1, 3).alias("codigo_icao")).distinct()
    names = [(a, n) for a, n, _ in codes.AIRLINES]
    ctry = [(a, c) for a, _, c in codes.AIRLINES]
    return base.select(
        "codigo_iata", "codigo_icao",
        code_map("codigo_icao", names, codes.UNKNOWN_AIRLINE[0]).alias("nombre"),
        code_map("codigo_icao", ctry, codes.UNKNOWN_AIRLINE[1]).alias("pais_codigo"))


def airline_dim(spark) -> DataFrame:
    """The 15 known airlines with 1-based ids (constant size: broadcast-safe)."""
    rows = [(i + 1, a, a[:2], n, c) for i, (a, n, c) in enumerate(codes.AIRLINES)]
    return spark.createDataFrame(rows, "aerolinea_id long, codigo_icao string, codigo_iata string, nombre string, pais_codigo string")


# J5 ---------------------------------------------------------------------------
def clean_flights(flights: DataFrame, airports: DataFrame, airlines: DataFrame) -> DataFrame:
    f = flights.where(not_blank("numero_vuelo") & F.col("origen_id").isNotNull() & F.col("destino_id").isNotNull())
    f = f.withColumn("icao_cs", F.substring(F.upper(F.trim("numero_vuelo")), 1, 3))
    # J1 names every airline that flies: one outside the known list is kept as unknown
    al = F.broadcast(airlines.select(F.col("codigo_icao").alias("icao_cs"), F.col("nombre").alias("_nombre")))
    o = airports.select(F.col("aeropuerto_id").alias("origen_id"), F.col("ident").alias("origen_ident"))
    d = airports.select(F.col("aeropuerto_id").alias("destino_id"), F.col("ident").alias("destino_ident"))
    f = f.join(al, "icao_cs", "left").withColumn("aerolinea", F.coalesce("_nombre", F.lit(codes.UNKNOWN_AIRLINE[0])))
    return (f.join(o, "origen_id").join(d, "destino_id")
             .select("vuelo_id", "numero_vuelo", "aerolinea", "origen_ident", "destino_ident",
                     "salida_programada", "llegada_programada", "estado"))


# J7 ---------------------------------------------------------------------------
def clean_passengers(reservations: DataFrame) -> DataFrame:
    first, last = field("doc", "first_name"), field("doc", "last_name")
    cls = F.col("clase")
    return reservations.where("pasajero_json is not null").withColumn("doc", document("pasajero_json")).select(
        F.concat(F.lit("DOC-"), F.col("reserva_id").cast("string")).alias("documento"),
        F.coalesce(field("doc", "document_type"), F.lit("PASSPORT")).alias("tipo_doc"),
        F.coalesce(field("doc", "nationality"), F.lit("CR")).alias("nacionalidad"),
        F.trim(F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))).alias("nombre"),
        F.when(field("doc", "frequent_flyer", "boolean"), "GOLD").alias("programa_fidelidad"),
        F.when(cls.isin("F", "J"), "FIRST").when(cls.isin("C", "W"), "BUSINESS").otherwise("ECONOMY").alias("categoria"),
    ).distinct()


# J8 ---------------------------------------------------------------------------
def booking_resolve(reservations, passengers, flights, boarding) -> DataFrame:
    docs = {"vuelo": document("vuelos_json"), "pax": document("pasajero_json")}
    r = reservations.where(F.col("pnr").isNotNull()).withColumns(docs).select(
        "reserva_id", "pnr", "clase", "tarifa_usd", "estado",
        field("vuelo", "flight_number").alias("fn"),
        F.concat(field("pax", "first_name"), F.lit(" "), field("pax", "last_name")).alias("pname"),
        field("pax", "nationality").alias("pnat")).where(F.col("fn").isNotNull())
    # DISTINCT ON (reserva_id) ORDER BY pasajero_id, boarding ts DESC NULLS LAST,
    # vuelo_id: the three lookups are independent, so each side is first
    # reduced to the one candidate that order would keep. Every join is
    # then N:1 -- a flight number shared by many flights, or a PNR boarded
    # many times, never multiplies the reservation rows.
    p = (passengers.groupBy(F.col("nombre").alias("pname"), F.col("nacionalidad").alias("pnat"))
         .agg(F.min("pasajero_id").alias("pasajero_id")))
    v = flights.groupBy(F.col("numero_vuelo").alias("fn")).agg(F.min("vuelo_id").alias("vuelo_id"))
    b = first_per_key(boarding.where(F.col("pnr").isNotNull())
                      .select("pnr", "boarding_id", F.col("asiento").alias("b_asiento"), F.col("timestamp_utc").alias("b_ts")),
                      ["pnr"], [*desc("b_ts", nulls_last=True, kind="ts"), F.col("boarding_id")])
    j = r.join(p, ["pname", "pnat"]).join(v, "fn").join(b, "pnr", "left")
    est = F.upper(F.col("estado"))
    rows = j.select(
        "reserva_id", "vuelo_id", "pasajero_id", "boarding_id", "b_ts",
        F.substring("pnr", 1, 10).alias("pnr"),
        F.substring("clase", 1, 5).alias("clase"),
        F.coalesce(F.substring("b_asiento", 1, 5), F.lit("NA")).alias("asiento"),
        F.col("tarifa_usd").cast("double").alias("tarifa_usd"),
        F.when(F.col("boarding_id").isNotNull(), "BOARDED")
         .when(est.isin("CONFIRMED", "CHECKED", "NOSHOW"), est).otherwise("CONFIRMED").alias("estado"))
    best = first_per_key(rows, ["reserva_id"],
                         [F.col("pasajero_id"), *desc("b_ts", nulls_last=True, kind="ts"),
                          F.col("vuelo_id"), F.coalesce(F.col("boarding_id"), F.lit(-1))])
    return best.drop("boarding_id", "b_ts")


# J9 ---------------------------------------------------------------------------
def baggage_latest(baggage: DataFrame, flights: DataFrame) -> DataFrame:
    b = baggage.where(F.col("tag_id").isNotNull() & F.col("timestamp_utc").isNotNull())
    j = b.join(flights.select("vuelo_id"), "vuelo_id")
    rows = j.select(
        F.substring("tag_id", 1, 20).alias("tag_id"), "vuelo_id", "baggage_id",
        code_map(F.upper("evento"), BAG_STATES, "CHECKED").alias("estado"),
        F.substring("aeropuerto", 1, 50).alias("ubicacion_actual"),
        F.col("timestamp_utc").alias("timestamp_ultimo_evento"))
    return first_per_key(rows, ["tag_id"],
                         [*desc("timestamp_ultimo_evento", kind="ts"), F.col("baggage_id")]).drop("baggage_id")


# J10 --------------------------------------------------------------------------
def clean_cargo(cargo: DataFrame, flights: DataFrame) -> DataFrame:
    c = cargo.where(F.col("awb").isNotNull() & (F.col("peso_kg") > 0) & (F.col("volumen_m3") > 0))
    j = with_parent(c, flights, "vuelo_id").withColumn("doc", document("declaracion_json"))
    t = F.upper("tipo_carga")
    rows = j.select(
        F.substring("awb", 1, 20).alias("awb"), "vuelo_id",
        F.substring(field("doc", "shipper"), 1, 200).alias("shipper"),
        F.substring(field("doc", "consignee"), 1, 200).alias("consignee"),
        F.when(t.isin(*codes.CARGO_TYPES), t).otherwise("GENERAL").alias("tipo"),
        F.col("peso_kg").cast("decimal(8,2)").alias("peso_kg"),
        F.col("volumen_m3").cast("decimal(6,2)").alias("volumen_m3"),
        F.substring(field("doc", "temperature_required"), 1, 10).alias("temperatura_req"),
        F.col("declaracion_json").isNotNull().alias("tiene_declaracion"),
        F.col("declaracion_json").alias("declaracion_aduanera"))
    return first_per_key(rows, ["awb"], [F.col("vuelo_id")])


# J11 --------------------------------------------------------------------------
def cargo_enrich(clean: DataFrame) -> DataFrame:
    """Fill shipper, consignee, temperature on rows where any is null.

    Like the reference, all three columns are rewritten on such rows.
    """
    k = F.col("awb")
    t = F.col("tipo")
    temp = (F.when(t == "PERECIBLE", pick(["2-8C", "-18C", "-25C", "0-4C"], k, "ce_t"))
             .when(t == "ANIMALES", pick(["15-25C", "18-22C"], k, "ce_t"))
             .when(t == "VALORADA", F.lit("AMBIENT"))
             .when(t == "PELIGROSA", pick(["AMBIENT", "15-30C", "COOL"], k, "ce_t"))
             .otherwise(F.lit("AMBIENT")))
    need = F.col("shipper").isNull() | F.col("consignee").isNull() | F.col("temperatura_req").isNull()
    shipper = F.concat(F.lit("SHIPPER-"), F.lpad((F.floor(u(k, "ce_s") * 1000)).cast("int").cast("string"), 4, "0"))
    consignee = F.concat(F.lit("CONSIGNEE-"), F.lpad((F.floor(u(k, "ce_c") * 1000)).cast("int").cast("string"), 4, "0"))
    # one projection: every column sees the row as it was before the update
    return clean.select(*[
        F.when(need, shipper).otherwise(F.col(c)).alias(c) if c == "shipper" else
        F.when(need, consignee).otherwise(F.col(c)).alias(c) if c == "consignee" else
        F.when(need, temp).otherwise(F.col(c)).alias(c) if c == "temperatura_req" else F.col(c)
        for c in clean.columns])


# J12 --------------------------------------------------------------------------
def landing_fuel(fuel: DataFrame) -> DataFrame:
    """Loads that rule M6 lets land; the others are in the report of ``rule_fuel``."""
    bad = (F.col("litros") > 250000) | (F.col("masa_kg") > F.col("litros") * F.lit(1.2).cast("decimal(2,1)"))
    return fuel.where(~F.coalesce(bad, F.lit(False)))


def judged_crew(crew: DataFrame, flights: DataFrame) -> DataFrame:
    """J12 rows with the M5 rule (``regla``) that keeps them from landing, else null.

    Duty is capped at 12 hours before the rule looks, so only short rests reject here; the raw
    limit is in the report ``rule_crew_fatigue``.
    """
    c = crew.where(F.col("vuelo_id").isNotNull() & F.col("report_time").isNotNull()
                   & F.col("duty_hours").isNotNull() & (F.col("duty_hours") > 0))
    j = with_parent(c, flights, "vuelo_id")
    rows = j.select(
        "roster_id", "vuelo_id", "crew_id",
        code_map(F.upper("rol"), CREW_ROLES, "FA").alias("rol"),
        F.col("report_time"),
        F.col("report_time").alias("duty_start"),
        plus_hours("report_time", "duty_hours").alias("duty_end"),
        F.least(F.col("duty_hours"), F.lit(12)).cast("decimal(4,2)").alias("horas_vuelo_duty"),
        F.col("descanso_horas").cast("decimal(5,2)").alias("descanso_horas"),
        F.col("descanso_minimo").cast("decimal(4,2)").alias("descanso_minimo_requerido"),
        (F.col("descanso_horas") >= F.col("descanso_minimo")).alias("descanso_minimo_cumple"))
    rows = first_per_key(rows, ["roster_id"], [F.col("vuelo_id")])
    return rows.withColumn("regla", F.when(F.col("horas_vuelo_duty") > 12, "M5_DUTY")
                           .when(F.col("descanso_horas") < F.col("descanso_minimo_requerido"), "M5_REST"))


def clean_crew(judged: DataFrame) -> DataFrame:
    """Duties that rule M5 lets land."""
    return judged.where(F.col("regla").isNull()).drop("regla")


def crew_quarantine(judged: DataFrame) -> DataFrame:
    """Duties that rule M5 rejects, with the rule; written in the same pass as those that land."""
    return judged.where(F.col("regla").isNotNull())


# J2 / J3 ------------------------------------------------------------------------
def synth_fleet(aircraft_ids: DataFrame) -> DataFrame:
    """Fleet rows generated per distinct aircraft slot (chained odds, T3)."""
    k = F.col("aeronave_id")
    return aircraft_ids.select(
        k,
        F.concat(F.lit("TI-"), F.lpad((k + 1).cast("string"), 4, "0")).alias("matricula"),
        pick(codes.AIRCRAFT_TYPES, k, "sf_tipo").alias("tipo"),
        F.when(u(k, "sf_s1") < 0.25, codes.SEAT_MAPS[0]).when(u(k, "sf_s2") < 0.50, codes.SEAT_MAPS[1])
         .when(u(k, "sf_s3") < 0.75, codes.SEAT_MAPS[2]).otherwise(codes.SEAT_MAPS[3]).alias("configuracion_asientos"),
        F.round((F.lit(500) + u(k, "sf_h") * 60000).cast("decimal(18,6)"), 2).cast("double").alias("horas_vuelo_totales"),
        F.when(u(k, "sf_e") < 0.90, "ACTIVO").otherwise("MANTENIMIENTO").alias("estado"),
        F.date_sub(F.lit("2026-01-01").cast("date"), F.floor(u(k, "sf_d") * 5000).cast("int")).alias("fecha_entrada_servicio"))


def inline_values_anti_insert(spark, fleet: DataFrame) -> DataFrame:
    """Inline registrations appended only when absent (VALUES + NOT EXISTS)."""
    inline = spark.createDataFrame(INLINE_AIRCRAFT, "matricula string, tipo string, configuracion_asientos string")
    new = inline.join(fleet.select("matricula"), "matricula", "left_anti").withColumn("origen", F.lit("INLINE"))
    old = fleet.select("matricula", "tipo", "configuracion_asientos").withColumn("origen", F.lit("FLEET"))
    return old.unionByName(new)


# J13 --------------------------------------------------------------------------
def workshops(spark, airports: DataFrame) -> DataFrame:
    """Workshops with airport by IATA, else a keyed pick among airports (C17)."""
    from contrail.operators.ids import keyed_pick_join
    w = spark.createDataFrame(WORKSHOPS, "nombre string, iata_code string, tipo string, capacidad int, certificaciones array<string>")
    by_iata = first_per_key(airports.where(F.col("iata").isNotNull())
                            .select(F.col("iata").alias("iata_code"), "aeropuerto_id"),
                            ["iata_code"], [F.col("aeropuerto_id")])
    j = w.join(by_iata, "iata_code", "left")
    j = keyed_pick_join(j, F.col("nombre"), "wk_ap", airports, ["aeropuerto_id"], ["aeropuerto_id"])
    return j.select(
        (F.row_number().over(_w_name()) ).alias("taller_id"),
        "nombre", F.coalesce("aeropuerto_id", "pick_aeropuerto_id").alias("aeropuerto_id"),
        "tipo", "capacidad", "certificaciones", F.lit(True).alias("activo"), "iata_code")


def _w_name():
    from pyspark.sql import Window
    # six constant rows: a global window over them is trivially small
    return Window.orderBy("nombre")


# J14 --------------------------------------------------------------------------
def engines_cross(spark, fleet: DataFrame) -> DataFrame:
    t = F.col("tipo")
    k = F.concat_ws("|", F.col("aeronave_id").cast("string"), F.col("posicion").cast("string"))
    modelo = (F.when(t.like("%A320%") | t.like("%A330%"), pick(["CFM56-5B", "V2500", "PW1100"], k, "eng_m"))
               .when(t.like("%B737%"), F.lit("CFM56-7B"))
               .when(t.like("%B787%"), pick(["TRENT-1000", "GENX-1B"], k, "eng_m"))
               .otherwise(F.lit("CFM56-7B")))
    # aircraft x (VALUES (1), (2)): two positions per row, as a narrow explode
    return fleet.withColumn("posicion", F.explode(F.array(F.lit(1), F.lit(2)))).select(
        (F.col("aeronave_id") * 2 + F.col("posicion") - 1).alias("motor_id"),
        "aeronave_id", "posicion", modelo.alias("modelo"),
        F.concat(F.lit("SN-"), F.col("matricula"), F.lit("-"), F.col("posicion").cast("string")).alias("serial_number"),
        F.round((F.lit(1000) + u(k, "eng_h") * 50000).cast("decimal(18,6)"), 2).cast("double").alias("horas_acumuladas"),
        F.floor(F.lit(500) + u(k, "eng_c") * 30000).cast("int").alias("ciclos_acumulados"))


# J15 --------------------------------------------------------------------------
def first_child_by_order(engines: DataFrame) -> DataFrame:
    """First engine of each aircraft by position (min_by, no correlated subquery)."""
    return engines.groupBy("aeronave_id").agg(F.min_by("motor_id", "posicion").alias("motor_id"))


def clean_maintenance(maint: DataFrame, fleet: DataFrame, engines: DataFrame, shops: DataFrame) -> DataFrame:
    m = maint.where(F.col("aeronave_id").isNotNull() & F.col("timestamp_utc").isNotNull()
                    & F.col("horas_aeronave").isNotNull() & (F.col("horas_aeronave") >= 0)
                    & F.col("accion").isNotNull())
    j = m.join(fleet.select("aeronave_id"), "aeronave_id").join(first_child_by_order(engines), "aeronave_id", "left")
    sh = F.broadcast(shops.select(F.col("iata_code"), F.col("taller_id").alias("taller_match")))
    j = j.join(sh, j.taller_codigo == sh.iata_code, "left")
    k = F.col("evento_id")
    act = F.upper("accion")
    hours = code_map(act, codes.ACTION_HOURS, codes.ACTION_HOURS_DEFAULT)
    cost = F.lit(500.0)
    for name, base, spread in reversed(ACTION_COST):
        cost = F.when(act == name, F.lit(base) + u(k, "mc") * spread).otherwise(cost)
    digits = F.regexp_replace("tecnico_id", "[^0-9]", "")
    rows = j.select(
        "evento_id", "aeronave_id", "motor_id",
        code_map(act, codes.ACTION_CHECK, "LINE").alias("tipo_check"),
        F.substring(F.coalesce("componente", F.lit("GENERAL")), 1, 50).alias("componente"),
        F.col("accion").alias("descripcion"),
        F.coalesce("taller_match", (F.floor(u(k, "mt") * len(WORKSHOPS)) + 1).cast("int")).alias("taller_id"),
        F.coalesce(F.when(digits != "", digits).cast("int"),
                   F.floor(F.lit(1) + u(k, "mtec") * 9999).cast("int")).alias("tecnico_id"),
        F.col("horas_aeronave").cast("decimal(10,2)").alias("horas_aeronave"),
        F.col("timestamp_utc").alias("fecha_inicio"),
        (F.col("timestamp_utc") + F.make_dt_interval(F.lit(0), hours.cast("int"))).alias("fecha_fin"),
        F.round(cost.cast("decimal(18,6)"), 2).alias("costo_usd"),
        "estado")
    return first_per_key(rows, ["evento_id"], [F.col("aeronave_id")])


# J16 --------------------------------------------------------------------------
def clean_fuel(fuel: DataFrame, flights: DataFrame, airports: DataFrame) -> DataFrame:
    f = fuel.where((F.col("litros") > 0) & (F.col("densidad_kgl") > 0) & (F.col("costo_total_usd") >= 0)
                   & F.col("timestamp_carga").isNotNull())
    j = f.join(flights.select("vuelo_id"), "vuelo_id").join(airports.select("aeropuerto_id"), "aeropuerto_id")
    rows = j.select(
        "fuel_id", "vuelo_id", "aeropuerto_id",
        F.col("litros").cast("decimal(10,2)").alias("litros"),
        F.col("densidad_kgl").cast("decimal(5,3)").alias("densidad_kgl"),
        (F.col("litros") * F.col("densidad_kgl")).cast("decimal(10,2)").alias("masa_kg"),
        F.when(F.col("litros") > 0, F.round(F.col("costo_total_usd") / F.col("litros"), 4))
         .otherwise(F.lit(0)).cast("decimal(10,4)").alias("precio_usd_litro"),
        F.col("costo_total_usd").cast("decimal(12,2)").alias("costo_total_usd"),
        F.col("timestamp_carga"))
    return first_per_key(rows, ["fuel_id"], [F.col("vuelo_id")])


# J17 --------------------------------------------------------------------------
def clean_positions(positions: DataFrame, flights: DataFrame) -> DataFrame:
    p = positions.where(F.col("latitud").isNotNull() & F.col("longitud").isNotNull()
                        & F.col("timestamp_utc").isNotNull() & F.col("velocidad_nudos").isNotNull()
                        & F.col("heading").isNotNull())
    j = with_parent(p, flights, "vuelo_id")
    k = F.col("posicion_id")
    rows = j.select(
        "posicion_id", "vuelo_id", "timestamp_utc",
        F.col("longitud").cast("double").alias("lon"),
        F.col("latitud").cast("double").alias("lat"),
        F.round(F.coalesce(F.col("altitud_pies") * F.lit(0.3048).cast("decimal(5,4)"), F.lit(0)), 4).cast("double").alias("z_m"),
        F.col("velocidad_nudos").cast("decimal(6,2)").cast("double").alias("velocidad_nudos"),
        F.col("heading").cast("double").alias("heading"),
        flight_phase("altitud_pies", "velocidad_nudos").alias("fase_vuelo"),
        F.col("aerovia_id").alias("aerovia_cercana_id"),
        # measured deviation from the source (the reference drew a random 0-5 NM)
        F.col("desviacion_nm").cast("double").alias("desviacion_nm"))
    return one_per_seldom_key(rows, ["posicion_id"], [F.col("vuelo_id")])


# J18 --------------------------------------------------------------------------
def clean_sensors(sensors: DataFrame) -> DataFrame:
    s = sensors.where(F.col("engine_id").isNotNull() & F.col("timestamp_utc").isNotNull()
                      & F.col("n1_pct").between(0, 110) & F.col("n2_pct").between(0, 110)
                      & F.col("egt_c").between(-50, 1200) & (F.col("fuel_flow_kgh") >= 0)
                      & (F.col("vibration") >= 0))
    return first_per_key(s, ["sensor_id"], [F.col("timestamp_utc")])


# J20 --------------------------------------------------------------------------
def clean_waypoints(navaids: DataFrame) -> DataFrame:
    n = navaids.where(F.col("type").isin(*WAYPOINT_TYPES))
    rows = n.select(
        F.col("id").alias("source_id"),
        F.substring("ident", 1, 10).alias("ident"),
        F.substring("name", 1, 100).alias("nombre"),
        F.col("type").alias("tipo"),
        F.when(F.col("frequency_khz") >= 0, F.col("frequency_khz")).alias("frecuencia_khz"),
        F.col("latitude_deg").alias("latitud_deg"), F.col("longitude_deg").alias("longitud_deg"),
        "elevation_ft",
        F.when(F.col("longitude_deg").isNotNull() & F.col("latitude_deg").isNotNull(),
               F.struct(F.col("longitude_deg").cast("double").alias("lon"),
                        F.col("latitude_deg").cast("double").alias("lat"),
                        F.coalesce(F.col("elevation_ft"), F.lit(0)).cast("double").alias("z")))
         .alias("ubicacion"),
        "iso_country", F.col("iso_region").alias("region_code"),
        F.when(F.col("dme_frequency_khz") >= 0, F.col("dme_frequency_khz")).alias("dme_frequency_khz"),
        F.substring("dme_channel", 1, 10).alias("dme_channel"),
        F.substring("filename", 1, 100).alias("fuente_archivo"))
    first = first_per_key(rows, ["ident"], [F.col("source_id")])
    return dense_index(first, ["ident"], "waypoint_id")


# J21 --------------------------------------------------------------------------
def airport_fk_enrich(airports: DataFrame, countries: DataFrame, regions: DataFrame) -> DataFrame:
    """Fill country_id / region_id only where null; build the point."""
    c = countries.select(F.col("code").alias("iso_country"), F.col("country_id").alias("c_id"))
    r = regions.select(F.col("code").alias("iso_region"), F.col("region_id").alias("r_id"))
    j = airports.join(c, "iso_country", "left").join(r, "iso_region", "left")
    lat, lon = F.col("latitude_deg").cast("double"), F.col("longitude_deg").cast("double")
    return j.select(
        "aeropuerto_id", "ident", "iso_country", "iso_region",
        F.coalesce("country_id", "c_id").alias("country_id"),
        F.coalesce("region_id", "r_id").alias("region_id"),
        F.when(lat.isNotNull() & lon.isNotNull() & lat.between(-90, 90) & lon.between(-180, 180),
               F.struct(lon.alias("lon"), lat.alias("lat"))).alias("ubicacion"))
