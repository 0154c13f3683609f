"""Seeded bronze generators.

One operator: every generated row is keyed by a row of a driver table,
and every attribute is ``u(key, salt)`` (one salt per call site, so the
reference's chained odds hold). Row counts therefore grow with the
driver tables, and a rerun -- or a retried task -- yields the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.functions import codes
from contrail.functions.jsondoc import document, field
from contrail.functions.xmldoc import to_document
from contrail.functions.det import pick, u
from contrail.functions.geo import sphere_distance_m
from contrail.plans import silver as _s
from contrail.plans.context import Layers
from contrail.plans.queries import _dbl, query
from contrail.sources.fixtures import add_minutes

AIRLINE_CODES = [a[0] for a in codes.AIRLINES]
# ---- fixed values --------------------------------------------------------------
ADSB_CALLSIGN_CODES = ["AAL", "DAL", "UAL", "AVA", "IBE", "AFR", "KLM", "BAW"]
ADSB_AIRCRAFT_TYPES = ["A320", "A321", "B737", "B738", "B789", "E190", "A359"]
NOTAM_TEXTS = [
    "RWY 07/25 CLOSED FOR MAINTENANCE",
    "TWY B CLOSED DUE TO PAVEMENT WORK",
    "ILS RWY 09 OUT OF SERVICE",
    "BIRD ACTIVITY VICINITY AERODROME",
    "CRANE OPERATING NEAR APRON",
    "FUEL SERVICE LIMITED AT FBO",
    "MILITARY EXERCISES IN AREA",
    "OBSTACLE LIGHTING UNSERVICEABLE",
    "NAVAID VOR/DME OUT OF SERVICE",
    "TAXIWAY LIGHTING REDUCED INTENSITY",
    "AIRSPACE RESTRICTED DUE TO VIP MOVEMENT",
    "WEATHER RADAR INOPERATIVE",
    "RUNWAY FRICTION LEVEL DEGRADED",
    "GROUND HANDLING SERVICES LIMITED",
    "TEMPORARY ATC FREQUENCY CHANGE",
]
# ---- end of fixed values -------------------------------------------------------


def nul(k: Column, salt: str, rate: float, expr: Column) -> Column:
    """NULL with probability ``rate``, else ``expr``."""
    return F.when(u(k, salt) < rate, F.lit(None)).otherwise(expr)


def ident_of(idx: Column) -> Column:
    return F.lpad(idx.cast("string"), 4, "0")


@query
def synth_positions(L: Layers) -> DataFrame:
    """Raw ADS-B, +-0.4 deg jitter round a keyed airport, reference null rates."""
    e = L.fx.t("events").select("event_id", "ts")
    k = F.col("event_id")
    ap = L.fx.airports.select("aeropuerto_id", "latitude_deg", "longitude_deg")
    e = e.withColumn("aeropuerto_id", F.floor(u(k, "p1_ap") * L.fx.n_airports).cast("bigint")).join(ap, "aeropuerto_id")
    has_pt = u(k, "p1_ptn") >= 0.05
    callsign = nul(k, "p1_csn", 0.15, F.concat(pick(ADSB_CALLSIGN_CODES, k, "p1_cs"),
                                                F.floor(u(k, "p1_csd") * 9999).cast("bigint").cast("string")))
    src = (F.when(u(k, "p1_s1") < 0.15, "OpenSky").when(u(k, "p1_s2") < 0.30, "FlightRadar24").otherwise("ADS-B Exchange"))
    jsrc = (F.when(u(k, "p1_j1") < 0.15, "OpenSky").when(u(k, "p1_j2") < 0.30, "FlightRadar24").otherwise("ADS-B Exchange"))
    out = e.select(
        F.col("event_id").alias("adsb_id"),
        nul(k, "p1_icn", 0.08, F.upper(F.substring(F.md5(F.concat(k.cast("string"), F.lit("|icao"))), 1, 6))).alias("icao24"),
        F.when(has_pt, (F.col("longitude_deg") + (u(k, "p1_dx") - 0.5) * 0.8).cast("decimal(10,6)")).alias("lon"),
        F.when(has_pt, (F.col("latitude_deg") + (u(k, "p1_dy") - 0.5) * 0.8).cast("decimal(10,6)")).alias("lat"),
        nul(k, "p1_altn", 0.10, (F.lit(500) + u(k, "p1_alt") * 39000).cast("decimal(10,2)")).alias("altitud_pies"),
        nul(k, "p1_vn", 0.07, (F.lit(120) + u(k, "p1_v") * 420).cast("decimal(8,2)")).alias("velocidad_nudos"),
        nul(k, "p1_hn", 0.06, (u(k, "p1_h") * 360).cast("decimal(5,2)")).alias("heading"),
        F.col("ts").alias("timestamp_utc"),
        callsign.alias("callsign"),
        F.to_json(F.struct(callsign.alias("callsign"), jsrc.alias("source"),
                           (F.lit(-40) - u(k, "p1_sig") * 35).cast("decimal(6,2)").alias("signal_strength_db"),
                           pick(ADSB_AIRCRAFT_TYPES, k, "p1_at").alias("aircraft_type"),
                           (u(k, "p1_em") < 0.01).alias("emergency"))).alias("raw_json"),
        src.alias("fuente"))
    return _dbl(out)


@query
def synth_flight_plans(L: Layers) -> DataFrame:
    """Plans with 7 % null then 11 % blank callsigns, dirty airports, XML body."""
    o = L.fx.t("orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    n = L.fx.n_airports
    cs = (F.when(u(k, "p2_c1") < 0.07, F.lit(None)).when(u(k, "p2_c2") < 0.11, F.lit(""))
           .otherwise(F.concat(pick(AIRLINE_CODES, k, "p2_al"), F.lpad((k % 10000).cast("string"), 4, "0"))))
    org = F.when(u(k, "p2_o1") < 0.03, F.lit(None)).when(u(k, "p2_o2") < 0.05, F.lit("")) \
           .otherwise(ident_of(F.floor(u(k, "p2_o") * n)))
    dst = F.when(u(k, "p2_d1") < 0.03, F.lit(None)).when(u(k, "p2_d2") < 0.05, F.lit("")) \
           .otherwise(ident_of(F.floor(u(k, "p2_d") * n)))
    rules = F.when(u(k, "p2_fr") < 0.9, "IFR").otherwise("VFR")
    ftype = F.when(u(k, "p2_ft") < 0.8, "S").otherwise("N")
    actype = pick(codes.AIRCRAFT_TYPES, k, "p2_ac")
    xml = to_document("flight_plan", F.struct(
        rules.alias("flight_rules"), ftype.alias("flight_type"), F.coalesce(org, F.lit("")).alias("origin"),
        F.coalesce(dst, F.lit("")).alias("destination"), actype.alias("aircraft_type")))
    return o.select(
        F.col("o_orderkey").alias("plan_id"), cs.alias("callsign"), org.alias("origen_icao"), dst.alias("destino_icao"),
        F.concat(pick(["UL", "UM", "UN", "UT", "UA"], k, "p2_aw"), F.floor(u(k, "p2_awn") * 999).cast("bigint").cast("string")).alias("aerovia"),
        F.concat(F.lit("FL"), (F.floor(u(k, "p2_fl") * 200) + 250).cast("bigint").cast("string")).alias("niveles"),
        add_minutes(F.col("o_orderdate"), F.floor(u(k, "p2_eta") * 1440)).alias("eta"),
        xml.alias("raw_xml"))


@query
def synth_reservations(L: Layers) -> DataFrame:
    """Reservations with 5/3/6/3 % nulls in pnr/class/fare/status (JSON fields shown parsed)."""
    r = L.fx.reservations
    return _dbl(r.select("reserva_id", "pnr", "clase", "tarifa_usd", "estado", "timestamp_utc",
                         field(document("pasajero_json"), "first_name").alias("first_name"),
                         field(document("pasajero_json"), "nationality").alias("nationality"),
                         field(document("vuelos_json"), "flight_number").alias("flight_number")))


@query
def synth_boarding(L: Layers) -> DataFrame:
    """Boarding rows reuse reservation PNRs; 20 % of passengers board twice."""
    return L.fx.boarding


@query
def synth_baggage(L: Layers) -> DataFrame:
    """P5: each PNR x 2 bags, events drawn with disordered times."""
    r = L.fx.reservations.where(F.col("pnr").isNotNull()).select("reserva_id", "pnr", "timestamp_utc")
    b = r.select("reserva_id", "pnr", "timestamp_utc", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("bag_no"))
    k = F.concat_ws("|", F.col("reserva_id").cast("string"), F.col("bag_no").cast("string"))
    return b.select(
        (F.col("reserva_id") * 2 + F.col("bag_no")).alias("baggage_id"),
        F.concat(F.lit("BG"), F.col("pnr"), F.col("bag_no").cast("string")).alias("tag_id"),
        "pnr",
        (F.col("reserva_id") * 10).cast("string").alias("vuelo_id"),
        ident_of(F.floor(u(k, "p5_ap") * L.fx.n_airports)).alias("aeropuerto"),
        nul(k, "p5_evn", 0.04, pick(["CHECKIN", "LOAD", "TRANSFER", "UNLOAD", "DELIVERED"], k, "p5_ev")).alias("evento"),
        add_minutes(F.col("timestamp_utc"), F.floor(u(k, "p5_t") * 2880)).alias("timestamp_utc"))


@query
def synth_cargo(L: Layers) -> DataFrame:
    """Cargo with 3 % missing flight and 4 % missing type."""
    c = L.fx.cargo
    k = F.col("awb")
    return _dbl(c.select("awb", nul(k, "p6_vn", 0.03, F.col("vuelo_id")).alias("vuelo_id"),
                         nul(k, "p6_tn", 0.04, F.col("tipo_carga")).alias("tipo_carga"), "peso_kg", "volumen_m3",
                         ident_of(F.floor(u(k, "p6_o") * L.fx.n_airports)).alias("origen"),
                         ident_of(F.floor(u(k, "p6_d") * L.fx.n_airports)).alias("destino"),
                         F.col("declaracion_json").isNotNull().alias("con_declaracion")))


@query
def synth_sensors(L: Layers) -> DataFrame:
    """Engine telemetry, n1 20-105 %, EGT 350-800 C, vibration 0.1-4.1, 5-8 % nulls."""
    e = L.fx.t("events").select("event_id", "user_id", "ts")
    k = F.col("event_id")
    return _dbl(e.select(
        F.col("event_id").alias("sensor_id"),
        F.concat(F.lit("ENG-"), F.lpad((F.col("user_id") % 50).cast("string"), 2, "0")).alias("engine_id"),
        nul(k, "p7_n1n", 0.05, (F.lit(20) + u(k, "p7_n1") * 85).cast("decimal(6,2)")).alias("n1_pct"),
        nul(k, "p7_n2n", 0.06, (F.lit(30) + u(k, "p7_n2") * 80).cast("decimal(6,2)")).alias("n2_pct"),
        nul(k, "p7_egn", 0.07, (F.lit(350) + u(k, "p7_eg") * 450).cast("decimal(7,2)")).alias("egt_c"),
        nul(k, "p7_ffn", 0.08, (F.lit(800) + u(k, "p7_ff") * 4200).cast("decimal(10,2)")).alias("fuel_flow_kgh"),
        nul(k, "p7_vbn", 0.05, (F.lit(0.1) + u(k, "p7_vb") * 4.0).cast("decimal(6,3)")).alias("vibration"),
        F.col("ts").alias("timestamp_utc")))


@query
def synth_maintenance(L: Layers) -> DataFrame:
    """Events over 6 registrations, 8 components, 6 actions, 3-7 % nulls."""
    e = L.fx.t("events").select("event_id", "ts")
    k = F.col("event_id")
    regs = [r[0] for r in _s.INLINE_AIRCRAFT]
    return _dbl(e.select(
        F.col("event_id").alias("evento_id"),
        nul(k, "p8_an", 0.03, pick(regs, k, "p8_a")).alias("aeronave_id"),
        nul(k, "p8_cn", 0.05, pick(["ENGINE", "APU", "LANDING_GEAR", "AVIONICS", "HYDRAULICS", "FUEL_SYSTEM",
                                    "CABIN", "BRAKES"], k, "p8_c")).alias("componente"),
        nul(k, "p8_acn", 0.04, pick(["INSPECTION", "CLEANING", "TEST", "REPAIR", "REPLACEMENT", "OVERHAUL"], k, "p8_ac")).alias("accion"),
        nul(k, "p8_tn", 0.06, F.concat(F.lit("MRO-"), pick(["BOG", "LAX", "MAD", "MIA", "PTY", "SJO"], k, "p8_t"))).alias("taller_id"),
        nul(k, "p8_ten", 0.07, F.concat(F.lit("TECH-"), F.lpad(F.floor(u(k, "p8_te") * 9999).cast("bigint").cast("string"), 4, "0"))).alias("tecnico_id"),
        nul(k, "p8_hn", 0.05, (u(k, "p8_h") * 60000).cast("decimal(10,2)")).alias("horas_aeronave"),
        F.col("ts").alias("timestamp_utc")))


@query
def synth_fuel(L: Layers) -> DataFrame:
    """Fuel uplifts with 4-6 % nulls; price is the total paid."""
    f = L.fx.flights.select("vuelo_id", "numero_vuelo", "origen_id", "salida_programada")
    k = F.col("vuelo_id")
    litros = (F.lit(3000) + u(k, "p9_l") * 85000).cast("decimal(12,2)")
    return _dbl(f.select(
        F.col("vuelo_id").alias("fuel_id"), F.col("numero_vuelo").alias("vuelo_id"),
        nul(k, "p9_apn", 0.04, ident_of(F.col("origen_id"))).alias("aeropuerto_icao"),
        nul(k, "p9_ln", 0.05, litros).alias("litros"),
        nul(k, "p9_dn", 0.04, (F.lit(0.78) + u(k, "p9_d") * 0.05).cast("decimal(5,3)")).alias("densidad_kgl"),
        nul(k, "p9_pn", 0.06, (litros * (F.lit(0.75) + u(k, "p9_p") * 0.20)).cast("decimal(12,2)")).alias("precio_usd"),
        add_minutes(F.col("salida_programada"), F.lit(-45)).alias("timestamp_utc")))


@query
def synth_crew(L: Layers) -> DataFrame:
    """P10: rosters with 7 role spellings (and NULL), duty 1-15 h, 3-6 % nulls."""
    li = L.fx.t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    k = F.concat_ws("|", *[F.col(c).cast("string") for c in ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]])
    roles = ["CAPTAIN", "FIRST_OFFICER", "FO", "RELIEF_PILOT", "PURSER", "CABIN_CREW", "LOADMASTER"]
    return _dbl(li.select(
        F.col("l_orderkey").alias("orden"), "l_linenumber", "l_partkey", "l_suppkey",
        nul(k, "p10_vn", 0.03, F.col("l_orderkey").cast("string")).alias("vuelo_id"),
        F.concat(F.lit("CREW-"), F.lpad(F.col("l_suppkey").cast("string"), 5, "0")).alias("crew_id"),
        nul(k, "p10_rn", 0.04, pick(roles, k, "p10_r")).alias("rol"),
        nul(k, "p10_tn", 0.05, add_minutes(F.col("l_shipdate"), F.floor(u(k, "p10_t") * 1440))).alias("report_time"),
        nul(k, "p10_dn", 0.06, (F.lit(1) + u(k, "p10_d") * 14).cast("decimal(5,2)")).alias("duty_hours")))


@query
def synth_airways(L: Layers) -> DataFrame:
    """Two-vertex 3-D airways; FL min 50-249, max 250-449; length on the sphere."""
    w = L.fx.airways
    km = sphere_distance_m("lat1", "lon1", "lat2", "lon2") / 1000
    return _dbl(w.select("aerovia_id", F.col("codigo").alias("designador"), "lat1", "lon1", "lat2", "lon2",
                         "nivel_min", "nivel_max", F.round(km, 2).alias("longitud_km")))


@query
def synth_notams(L: Layers) -> DataFrame:
    """NOTAMs at an airport, radius 0-49 NM, validity 1-30 days, text from 15 phrases."""
    n = L.fx.notams
    k = F.col("notam_id")
    # the named intermediate of a CROSS JOIN LATERAL is a plain projection (C11)
    return n.select("notam_id", "ident", "aeropuerto_id", "tipo",
                    F.concat(F.lit("REF-"), F.lpad(F.floor(u(k, "j19_ref") * 99999).cast("bigint").cast("string"), 5, "0"),
                             F.lit("/24")).alias("referencia"),
                    "radio_nm", "altura_min",
                    (F.col("altura_min") + F.floor(F.lit(1000) + u(k, "j19_h") * 30000).cast("int")).alias("altura_max"),
                    "valido_desde", "valido_hasta",
                    F.concat(F.lit("NOTAM "), pick(NOTAM_TEXTS, k, "j19_txt")).alias("raw_text"))
