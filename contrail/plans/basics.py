"""Sources, scalar functions, verification queries and join shapes.

Each query exercises one operator family of SURVEY §2 over data derived
from the driver tables, so its work grows with them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import codes
from contrail.functions.conform import avg_dec, flight_phase as phase_expr, minutes_between
from contrail.functions.det import hash_order, pick, u
from contrail.functions.jsondoc import document, field, fields
from contrail.functions.xmldoc import from_document, to_document
from contrail.operators.ids import dense_index, keyed_pick_join
from contrail.operators.rules import code_lengths, expectation_counts
from contrail.plans import silver as _s
from contrail.plans.context import Layers
from contrail.plans.queries import _dbl, query
from contrail.session import scratch_path
from contrail.sources.schemas import CATALOG_SCHEMAS, read_typed, struct


# ---- A: sources ----------------------------------------------------------------
@query
def scan_typed(L: Layers) -> DataFrame:
    """Scan with the declared schema; pruning and pushdown still apply."""
    o = read_typed(L.spark, L.fx.sf_dir, "orders")
    return o.where(F.col("o_orderstatus").isin("O", "F", "P")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")


@query
def csv_catalog_load(L: Layers) -> DataFrame:
    """A2: the countries catalog round-trips through CSV with an explicit schema."""
    path = scratch_path(L.spark, f"catalog/countries-{uuid.uuid4().hex}")
    L.fx.countries.write.mode("overwrite").option("header", True).csv(path)
    return (L.spark.read.schema(struct(CATALOG_SCHEMAS["countries"]))
            .option("header", True).option("mode", "FAILFAST").csv(path))


@query
def retype_columns(L: Layers) -> DataFrame:
    """Text columns retyped, renamed, dropped and defaulted."""
    p = L.fx.t("part")
    raw = p.select(
        F.col("p_partkey").cast("string").alias("id"),
        (F.col("p_size") % 2).cast("string").alias("lighted"),
        F.when(F.col("p_size") % 7 == 0, F.lit("n/a")).otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string")).alias("length_ft"),
        F.col("p_size").cast("string").alias("width_ft"),
        F.col("p_name").alias("surface"),
        F.when(F.col("p_size") % 5 == 0, F.lit(None)).otherwise(F.col("p_brand")).alias("airport_ident"))
    typed = raw.select(
        F.col("id").cast("bigint").alias("id"),
        F.col("lighted").cast("int").cast("boolean").alias("lighted"),
        F.col("length_ft").try_cast("decimal(8,2)").alias("length_ft"),
        F.col("width_ft").cast("int").cast("decimal(8,2)").alias("width_ft"),
        "surface", "airport_ident")
    evolved = (typed.withColumnRenamed("surface", "superficie")
               .withColumn("width_ft", F.col("width_ft").cast("decimal(10,2)"))
               .withColumn("airport_ident", F.coalesce("airport_ident", F.lit("UNKN")))
               .withColumn("activo", F.lit(True)))
    return _dbl(evolved)


@query
def json_extract(L: Layers) -> DataFrame:
    """JSON text columns parsed once as variants, fields taken by type."""
    r = L.fx.reservations
    doc = r.select("reserva_id", document("pasajero_json").alias("p"), document("vuelos_json").alias("v"))
    return doc.select("reserva_id", *[field("p", n).alias(n) for n in ("first_name", "last_name", "document_type", "nationality")],
                      field("p", "frequent_flyer", "boolean").alias("frequent_flyer"),
                      *[field("v", n).alias(n) for n in ("flight_number", "origin", "destination", "airline")])


@query
def json_each(L: Layers) -> DataFrame:
    """jsonb_each_text over seat maps."""
    a = fields(L.fleet.select("aeronave_id", document("configuracion_asientos").alias("doc")), "doc", "clase")
    return a.select("aeronave_id", "clase", F.col("value").cast("int").alias("asientos"))


@query
def json_build(L: Layers) -> DataFrame:
    """Raw ADS-B payload built as JSON text (null fields are omitted)."""
    p = L.fx.positions
    js = F.to_json(F.struct(
        F.concat(F.lit("FL"), F.col("vuelo_id").cast("string")).alias("callsign"),
        F.lit("ADS-B").alias("source"),
        F.col("altitud_pies").alias("altitude_ft"),
        (F.col("aerovia_id") == 0).alias("emergency")))
    return p.select("posicion_id", js.alias("raw_json"))


@query
def xml_roundtrip(L: Layers) -> DataFrame:
    """Flight-plan XML documents written from a struct, then read back by schema in one parse."""
    plan = F.struct(
        F.when(F.col("vuelo_id") % 4 == 0, "VFR").otherwise("IFR").alias("flight_rules"),
        F.when(F.col("vuelo_id") % 3 == 0, "N").otherwise("S").alias("flight_type"),
        F.lpad(F.col("origen_id").cast("string"), 4, "0").alias("origin"),
        F.lpad(F.col("destino_id").cast("string"), 4, "0").alias("destination"),
        F.col("aeronave_id").cast("int").alias("aircraft_type"))
    x = L.fx.flights.select("vuelo_id", to_document("flight_plan", plan).alias("raw_xml"))
    read = from_document("raw_xml", "flight_plan", "flight_rules string, origin string, destination string, aircraft_type int")
    return x.select("vuelo_id", "raw_xml", read.alias("p")).select("vuelo_id", "raw_xml", "p.*")


@query
def series_numeric(L: Layers) -> DataFrame:
    """generate_series(1, n) with n read from the data (airport count)."""
    n = L.fx.n_airports
    return L.spark.range(1, n + 1).select(F.col("id"), (F.col("id") * F.col("id")).alias("id_sq"))


# ---- B / H: scalar expressions ---------------------------------------------------
@query
def flight_phase(L: Layers) -> DataFrame:
    p = L.fx.positions
    return _dbl(p.select("posicion_id", "altitud_pies", "velocidad_nudos",
                         phase_expr("altitud_pies", "velocidad_nudos").alias("fase_vuelo")))


@query
def string_functions(L: Layers) -> DataFrame:
    f = L.fx.flights
    cs = F.col("numero_vuelo")
    return f.select(
        "vuelo_id",
        F.substring(F.upper(F.trim(cs)), 1, 3).alias("prefijo"),
        F.concat(F.col("codigo_aerolinea"), F.lit("-"), cs).alias("etiqueta"),
        F.lpad(F.col("vuelo_id").cast("string"), 3, "0").alias("id_lpad3"),
        F.upper(F.substring(F.md5(F.col("vuelo_id").cast("string")), 1, 6)).alias("pnr_sintetico"),
        F.char_length(cs).alias("largo"))


@query
def dq_airline_codes(L: Layers) -> DataFrame:
    """IATA <= 2, ICAO <= 3, country <= 2 chars (trimmed) of the airlines that fly; null passes.

    An airline's code is all letters before the flight number, not cut to length, so a code that is
    too long is seen; airlines outside the known list have neither IATA code nor country.
    """
    flying = (L.fx.flights.select(F.regexp_extract(F.upper(F.trim("numero_vuelo")), "^([A-Z]+)", 1).alias("codigo_icao"))
              .where(F.length("codigo_icao") > 0).distinct())
    known = F.broadcast(L.airlines.select("codigo_icao", "codigo_iata", F.col("pais_codigo").alias("pais_base")))
    return expectation_counts(flying.join(known, "codigo_icao", "left"), "aerolineas",
                              code_lengths({"codigo_iata": 2, "codigo_icao": 3, "pais_base": 2}))


@query
def digits_from_text(L: Layers) -> DataFrame:
    m = L.fx.maintenance
    d = F.regexp_replace("tecnico_id", "[^0-9]", "")
    return m.select("evento_id", "tecnico_id",
                    F.when(d == "", F.lit(None)).otherwise(d).try_cast("int").alias("tecnico_num"))


@query
def datetime_functions(L: Layers) -> DataFrame:
    f = L.fx.flights
    return f.select(
        "vuelo_id",
        minutes_between("llegada_programada", "salida_programada").alias("block_min"),
        F.round(minutes_between("salida_real", "salida_programada") / 60, 4).alias("delay_h"),
        (F.col("salida_programada") + F.make_dt_interval(F.lit(0), (F.col("vuelo_id") % 5).cast("int"))).alias("mas_horas"),
        F.to_utc_timestamp(F.col("salida_programada").cast("timestamp"), "America/Costa_Rica")
         .cast("timestamp_ntz").alias("salida_utc_desde_cr"),
        F.datediff(F.col("llegada_programada").cast("date"), F.col("salida_programada").cast("date")).alias("dias"))


@query
def math_functions(L: Layers) -> DataFrame:
    li = L.fx.t("lineitem")
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    disc = F.col("l_discount").cast("decimal(4,2)")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(price * disc, 2).cast("double").alias("descuento"),
        F.floor(F.col("l_quantity") / 7).alias("piso"),
        F.abs(price - 30000).cast("double").alias("distancia_30k"),
        F.round(F.col("l_quantity") / 4).cast("int").alias("cuartos_redondeados"),
        (F.col("l_quantity") / 4).cast("int").alias("cuartos_truncados"))


@query
def seeded_uniform(L: Layers) -> DataFrame:
    o = L.fx.t("orders")
    k = F.col("o_orderkey")
    # chained CASE with one fresh salt per branch keeps the reference's odds
    st = (F.when(u(k, "s1") < 0.60, "SCHED").when(u(k, "s2") < 0.80, "ACTIVE")
           .when(u(k, "s3") < 0.95, "LANDED").when(u(k, "s4") < 0.98, "DIVERTED").otherwise("CANCEL"))
    return o.select("o_orderkey", u(k, "demo").alias("u"), st.alias("estado_sintetico"))


@query
def array_functions(L: Layers) -> DataFrame:
    w = L.workshops.select("taller_id", "nombre", F.explode("certificaciones").alias("certificacion"),
                           F.array_contains("certificaciones", "FAA-145").alias("tiene_faa"),
                           F.size("certificaciones").alias("n_cert"),
                           F.element_at("certificaciones", 1).alias("primera"))
    return w


@query
def conditional_functions(L: Layers) -> DataFrame:
    f = L.fx.flights
    return f.select(
        "vuelo_id",
        F.coalesce("salida_real", "salida_programada").alias("salida_efectiva"),
        F.nullif(F.col("numero_vuelo"), F.lit("")).alias("numero_o_nulo"),
        F.least(F.col("origen_id"), F.col("destino_id")).alias("menor_aeropuerto"),
        F.greatest(minutes_between("salida_real", "salida_programada"), F.lit(0.0)).alias("retraso_no_negativo"))


@query
def unit_conversions(L: Layers) -> DataFrame:
    p = L.fx.positions
    return p.select(
        "posicion_id",
        (F.col("altitud_pies") * F.lit(0.3048).cast("decimal(5,4)")).cast("double").alias("altitud_m"),
        F.round(F.col("altitud_pies") / 100, 0).cast("int").alias("nivel_vuelo"),
        (F.col("desviacion_nm") * 1852).cast("double").alias("desviacion_m"),
        (F.col("desviacion_nm") * F.lit(1.852).cast("decimal(4,3)")).cast("double").alias("desviacion_km"))


@query
def geo_points(L: Layers) -> DataFrame:
    from contrail.functions.geo import valid_coordinates
    a = L.fx.airports
    lat, lon = F.col("latitude_deg").cast("double"), F.col("longitude_deg").cast("double")
    pt = F.when(valid_coordinates(lat, lon), F.struct(lon.alias("x"), lat.alias("y"),
                                                      (F.col("elevation_ft") * F.lit(0.3048).cast("decimal(5,4)"))
                                                      .cast("double").alias("z")))
    return a.select("aeropuerto_id", pt.alias("p")).select(
        "aeropuerto_id", F.col("p.x").alias("st_x"), F.col("p.y").alias("st_y"), F.col("p.z").alias("st_z"))


@query
def wkt_linestring_parse(L: Layers) -> DataFrame:
    """LINESTRING Z text -> array of (lon, lat, z) vertices."""
    w = L.fx.airways
    z1 = (F.col("nivel_min") * 100 * F.lit(0.3048).cast("decimal(5,4)")).cast("decimal(12,4)")
    z2 = (F.col("nivel_max") * 100 * F.lit(0.3048).cast("decimal(5,4)")).cast("decimal(12,4)")
    wkt = F.concat(F.lit("LINESTRING Z ("), F.col("lon1").cast("string"), F.lit(" "), F.col("lat1").cast("string"),
                   F.lit(" "), z1.cast("string"), F.lit(", "), F.col("lon2").cast("string"), F.lit(" "),
                   F.col("lat2").cast("string"), F.lit(" "), z2.cast("string"), F.lit(")"))
    nums = F.regexp_extract_all(wkt, F.lit(r"(-?[0-9]+\.?[0-9]*)"), 1)
    verts = F.transform(F.sequence(F.lit(0), (F.size(nums) / 3 - 1).cast("int")),
                        lambda i: F.struct(F.element_at(nums, i * 3 + 1).cast("double").alias("lon"),
                                           F.element_at(nums, i * 3 + 2).cast("double").alias("lat"),
                                           F.element_at(nums, i * 3 + 3).cast("double").alias("z")))
    g = w.select("aerovia_id", wkt.alias("wkt"), verts.alias("v"))
    return g.select("aerovia_id", "wkt", F.size("v").alias("n_vertices"),
                    F.col("v")[0]["lon"].alias("lon1"), F.col("v")[0]["lat"].alias("lat1"), F.col("v")[0]["z"].alias("z1"),
                    F.col("v")[1]["lon"].alias("lon2"), F.col("v")[1]["lat"].alias("lat2"), F.col("v")[1]["z"].alias("z2"))


# ---- F: top-k and sampling ---------------------------------------------------------
@query
def top_n_preview(L: Layers) -> DataFrame:
    """the 20 longest-delayed flights (a top-k report; the LIMIT is the feature)."""
    hv = L.fact_flight.select("vuelo_id", "delay_min", "delay_code", "ruta_id")
    return hv.orderBy(F.col("delay_min").desc(), F.col("vuelo_id").asc()).limit(20)


@query
def hash_sample(L: Layers) -> DataFrame:
    """ORDER BY random() LIMIT 5000 as a keyed hash order (a sampling operator)."""
    b = L.fx.bookings.select("pv_id", "vuelo_id", "pasajero_id", "clase", "tarifa_usd")
    key = F.concat_ws("|", "pv_id", "pasajero_id", "clase", "tarifa_usd")
    return _dbl(b.orderBy(hash_order(key, "sample"), "pv_id").limit(5000))


# ---- G / O: verification queries ----------------------------------------------------
@query
def table_row_counts(L: Layers) -> DataFrame:
    parts = [("vuelos", L.fx.flights), ("pasajeros_vuelo", L.fx.bookings), ("carga_vuelo", L.fx.cargo),
             ("tripulacion_vuelo", L.fx.crew), ("combustible_carga", L.fx.fuel), ("posicionamiento", L.fx.positions),
             ("aeronaves", L.fleet), ("motores", L.engines), ("talleres_mro", L.workshops)]
    out = None
    for name, df in parts:
        c = df.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        out = c if out is None else out.unionByName(c)
    return out


@query
def coverage_check(L: Layers) -> DataFrame:
    """Which expected codes exist (left join from an inline list)."""
    want = L.spark.createDataFrame([(c,) for c in ["AVA", "DAL", "UAL", "AAL", "IBE", "AFR", "KLM", "BAW",
                                                   "CMP", "JBU", "QTR", "ACA", "SWA", "VOI", "JAL", "DLH", "LAN"]],
                                   "codigo_icao string")
    have = _s.clean_airlines(L.fx.flights).select("codigo_icao", "nombre")
    return (want.join(have, "codigo_icao", "left")
                .select("codigo_icao", "nombre", F.col("nombre").isNotNull().alias("existe"))
                .orderBy("codigo_icao"))


@query
def booking_profile(L: Layers) -> DataFrame:
    b = _s.booking_resolve(L.fx.reservations, L.fx.passengers, L.fx.flights, L.fx.boarding)
    return b.agg(F.count("*").alias("total_filas"), F.count_distinct("pnr").alias("pnrs_unicos"),
                 F.count_distinct("vuelo_id").alias("vuelos_distintos"),
                 F.count_distinct("pasajero_id").alias("pasajeros_distintos"),
                 F.sum(F.when(F.col("estado") == "BOARDED", 1).otherwise(0)).alias("abordados"))


@query
def crew_rollup(L: Layers) -> DataFrame:
    """ROLLUP(rol) with grouping_id telling the total row from a null role."""
    return (L.crew.rollup("rol").agg(F.count("*").alias("total_filas"),
                                     F.count_distinct("vuelo_id").alias("vuelos_distintos"),
                                     F.grouping_id().alias("nivel")))


@query
def null_profile(L: Layers) -> DataFrame:
    m = L.maintenance
    return m.agg(F.count("*").alias("total_eventos"), F.count("taller_id").alias("con_taller"),
                 (F.count("*") - F.count("taller_id")).alias("sin_taller"), F.count("motor_id").alias("con_motor"),
                 (F.count("*") - F.count("motor_id")).alias("sin_motor"))


@query
def flights_by_year(L: Layers) -> DataFrame:
    return (L.fx.flights.select(F.year("salida_programada").alias("anio"))
            .groupBy("anio").agg(F.count("*").alias("vuelos")).orderBy("anio"))


@query
def fuel_coverage(L: Layers) -> DataFrame:
    """Four scalar subqueries answered by one full outer join of flights
    with fuel rows counted per flight (no cross product)."""
    f = L.fx.flights.groupBy("vuelo_id").agg(F.count("*").alias("n_vuelos"))
    cb = L.fx.fuel.groupBy(F.col("vuelo_id").alias("fuel_vuelo")).agg(F.count("*").alias("n_fuel"))
    j = f.join(cb, f.vuelo_id == cb.fuel_vuelo, "full_outer")
    return j.agg(
        F.coalesce(F.sum("n_vuelos"), F.lit(0)).alias("total_vuelos"),
        F.coalesce(F.sum("n_fuel"), F.lit(0)).alias("registros_fuel"),
        F.count("fuel_vuelo").alias("vuelos_distintos_con_fuel"),
        F.count(F.when(F.col("fuel_vuelo").isNull(), F.col("vuelo_id"))).alias("vuelos_sin_fuel"))


@query
def yield_profile(L: Layers) -> DataFrame:
    fp = L.fact_passenger
    return fp.agg(F.count("*").alias("total"), F.count("yield_usd_rpk").alias("con_yield"),
                  (F.count("*") - F.count("yield_usd_rpk")).alias("sin_yield"),
                  avg_dec("yield_usd_rpk", 4, 4).alias("yield_promedio"),
                  F.round(F.min("yield_usd_rpk"), 4).alias("yield_min"),
                  F.round(F.max("yield_usd_rpk"), 4).alias("yield_max"))


@query
def fact_cargo_totals(L: Layers) -> DataFrame:
    hc = L.fact_cargo
    w = F.sum(F.col("cargo_weight_kg").cast("decimal(18,2)"))
    return hc.agg(F.count("*").alias("total_filas"), F.count_distinct("tiempo_id").alias("fechas_distintas"),
                  F.count_distinct("ruta_id").alias("rutas_distintas"),
                  F.round(w, 2).cast("double").alias("peso_total_kg"),
                  F.round(w / 1000, 2).cast("double").alias("toneladas_total"),
                  F.round(F.sum(F.col("cargo_revenue_usd").cast("decimal(18,2)")), 2).cast("double").alias("revenue_total"),
                  avg_dec("yield_usd_kgkm", 4, 4).alias("yield_promedio"),
                  F.sum("perishable_count").alias("perecibles_total"),
                  F.sum("dangerous_goods_count").alias("peligrosa_total"),
                  F.sum("customs_hold_count").alias("retenciones_aduana"))


# ---- C: join shapes --------------------------------------------------------------
@query
def flights_without_fuel(L: Layers) -> DataFrame:
    return L.fx.flights.join(L.fx.fuel.select("vuelo_id"), "vuelo_id", "left_anti").select("vuelo_id", "numero_vuelo")


@query
def join_json_key(L: Layers) -> DataFrame:
    r = L.fx.reservations.select("reserva_id", field(document("vuelos_json"), "flight_number").alias("fn"))
    v = L.fx.flights.select("vuelo_id", F.col("numero_vuelo").alias("fn"))
    return r.join(v, "fn").select("reserva_id", "vuelo_id", F.col("fn").alias("numero_vuelo"))


@query
def row_multiply(L: Layers) -> DataFrame:
    """Each PNR x 2 bags via explode(sequence) (no cross join)."""
    r = L.fx.reservations.where(F.col("pnr").isNotNull())
    return r.select("reserva_id", "pnr", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("bag_no")).select(
        "reserva_id", "pnr", "bag_no", F.concat(F.lit("BG"), F.col("pnr"), F.col("bag_no").cast("string")).alias("tag_id"))


@query
def lateral_pick_other(L: Layers) -> DataFrame:
    """Per origin airport, one other airport chosen by a keyed draw (never itself)."""
    ap = dense_index(L.fx.airports.select("aeropuerto_id"), ["aeropuerto_id"], "ix", start=0)
    n = ap.count()  # one scalar; the index is already written out
    o = ap.withColumn("j", F.floor(u(F.col("aeropuerto_id"), "other") * F.lit(n - 1)).cast("long"))
    o = o.withColumn("j", F.when(F.col("j") >= F.col("ix"), F.col("j") + 1).otherwise(F.col("j")))
    d = ap.select(F.col("ix").alias("j"), F.col("aeropuerto_id").alias("destino_id"))
    return o.join(d, "j").select(F.col("aeropuerto_id").alias("origen_id"), "destino_id")


@query
def keyed_random_pick(L: Layers) -> DataFrame:
    """One aircraft per flight by a keyed draw over the dense fleet index."""
    f = L.fx.flights.select("vuelo_id")
    out = keyed_pick_join(f, F.col("vuelo_id"), "pick_ac", L.fleet, ["aeronave_id"], ["aeronave_id", "matricula"])
    return out.select("vuelo_id", F.col("pick_aeronave_id").alias("aeronave_id"), F.col("pick_matricula").alias("matricula"))
