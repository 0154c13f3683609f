"""Aviation-shaped views derived from the driver tables (FIXTURES.md §3).

The reference's inputs are airline records; the driver ships TPC-H-like
tables. Every view here is a narrow (map-only) derivation of one driver
table, joined at most to a bounded dimension (nation, region: 25 and 5
rows). Random attributes come from ``u(key, salt)`` so the rows are
identical on every run and every engine; the DuckDB oracle repeats the
same derivations as CTEs (``contrail.oracle.ctes``).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.functions import codes
from contrail.functions.det import pick, u
from contrail.sources.tables import read_table

AIRLINE_CODES = [a[0] for a in codes.AIRLINES]


def add_minutes(ts: Column, n: Column) -> Column:
    return F.timestamp_add("MINUTE", n.cast("bigint"), ts)


def nation_code(n: Column) -> Column:
    """Nation key -> 2-letter country code (first 8 named, else zero-padded)."""
    arr = F.array(*[F.lit(c) for c in codes.NATION_CODES])
    return F.when(n < len(codes.NATION_CODES), F.try_element_at(arr, (n + 1).cast("int"))) \
        .otherwise(F.lpad(n.cast("string"), 2, "0"))


def region_continent(r: Column) -> Column:
    arr = F.array(*[F.lit(c) for c in codes.REGION_CONTINENT])
    return F.coalesce(F.try_element_at(arr, (r + 1).cast("int")), F.lit("OC"))


def dec(c: Column, p: int, s: int) -> Column:
    return c.cast(f"decimal({p},{s})")


class materialized(cached_property):
    """A fixture the pipelines read many times: handed to the owner's
    ``keep`` hook (which may write it once to the shared folder)."""

    def __set_name__(self, owner, name):
        super().__set_name__(owner, name)
        self._name = name

    def __get__(self, instance, owner=None):
        if instance is None:
            return self
        if self._name not in instance.__dict__:
            keep = getattr(instance, "keep", None)
            instance.__dict__[self._name] = (keep("fx_" + self._name, lambda: self.func(instance)) if keep
                                             else self.func(instance))
        return instance.__dict__[self._name]


class Fixtures:
    """Lazy DataFrames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, keep=None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.keep = keep

    def t(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ---- bounded dimension sizes -----------------------------------
    @cached_property
    def n_airports(self) -> int:
        # Parquet row count comes from footers; keys are 0..n-1.
        return self.t("supplier").count()

    @cached_property
    def n_passengers(self) -> int:
        return self.t("customer").count()

    # ---- catalogs ------------------------------------------------------
    @cached_property
    def nations(self) -> DataFrame:
        n, r = self.t("nation"), self.t("region")
        return (n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
                 .select("n_nationkey", "n_name", "r_regionkey", "r_name",
                         nation_code(F.col("n_nationkey")).alias("iso_country"),
                         region_continent(F.col("r_regionkey")).alias("continent")))

    @cached_property
    def countries(self) -> DataFrame:
        return self.nations.select(
            F.col("n_nationkey").cast("int").alias("country_id"),
            F.col("iso_country").alias("code"),
            F.col("n_name").alias("name"),
            "continent",
            F.concat(F.lit("https://en.wikipedia.org/wiki/"), F.col("n_name")).alias("wikipedia_link"),
            F.lit(None).cast("string").alias("keywords"))

    @cached_property
    def regions(self) -> DataFrame:
        return self.nations.select(
            F.col("n_nationkey").cast("int").alias("region_id"),
            F.concat_ws("-", "iso_country", F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("code"),
            F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("local_code"),
            F.concat_ws(" ", "n_name", "r_name").alias("name"),
            "continent", "iso_country",
            F.lit(None).cast("string").alias("wikipedia_link"),
            F.lit(None).cast("string").alias("keywords"))

    @materialized
    def airports(self) -> DataFrame:
        s = self.t("supplier")
        k = F.col("s_suppkey")
        ident = F.lpad(k.cast("string"), 4, "0")
        ui = u(k, "icao")
        return (s.join(F.broadcast(self.nations), s.s_nationkey == F.col("n_nationkey"))
                 .select(
                     k.alias("aeropuerto_id"),
                     ident.alias("ident"),
                     pick(["large_airport", "medium_airport", "small_airport"], k, "atype").alias("type"),
                     F.col("s_name").alias("nombre"),
                     dec(u(k, "lat") * 170 - 85, 10, 6).alias("latitude_deg"),
                     dec(u(k, "lon") * 360 - 180, 10, 6).alias("longitude_deg"),
                     F.floor(u(k, "elev") * 8000).cast("int").alias("elevation_ft"),
                     F.col("continent"),
                     F.col("iso_country"),
                     F.concat_ws("-", "iso_country", F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias("iso_region"),
                     F.col("n_name").alias("municipality"),
                     F.when(ui < 0.1, F.lit(None)).when(ui < 0.2, F.lit("")).otherwise(ident).alias("icao"),
                     F.when(u(k, "iata") < 0.4, F.lit(None))
                      .otherwise(F.upper(F.substring(F.md5(ident), 1, 3))).alias("iata"),
                     F.when(u(k, "cid") < 0.5, F.lit(None)).otherwise(F.col("n_nationkey").cast("int")).alias("country_id"),
                     F.when(u(k, "rid") < 0.5, F.lit(None)).otherwise(F.col("n_nationkey").cast("int")).alias("region_id"),
                 ))

    # ---- fleet -----------------------------------------------------------
    @materialized
    def aircraft(self) -> DataFrame:
        """One aircraft per distinct fleet slot used by the flights."""
        ids = self.t("orders").select((F.col("o_custkey") % 100).alias("aeronave_id")).distinct()
        k = F.col("aeronave_id")
        return ids.select(
            k,
            F.concat(F.lit("TI-"), F.lpad(k.cast("string"), 4, "0")).alias("matricula"),
            pick(codes.AIRCRAFT_TYPES, k, "tipo").alias("tipo"),
            pick(codes.SEAT_MAPS, k, "seats").alias("configuracion_asientos"),
            dec(u(k, "horas") * 60000 + 500, 10, 2).alias("horas_vuelo"),
            F.when(u(k, "est") < 0.85, "ACTIVO").when(u(k, "est") < 0.95, "MANTENIMIENTO")
             .otherwise("INACTIVO").alias("estado"),
            F.date_sub(F.lit("2026-01-01").cast("date"), F.floor(u(k, "alta") * 5000).cast("int")).alias("fecha_alta"),
        )

    # ---- flights ----------------------------------------------------------
    @materialized
    def flights(self) -> DataFrame:
        o = self.t("orders")
        k = F.col("o_orderkey")
        n_ap = F.lit(self.n_airports)
        a, b = u(k, "orig"), u(k, "dest")
        a8 = a * a * a * a * a * a * a * a
        b8 = b * b * b * b * b * b * b * b
        airline_idx = F.floor(u(k, "airline") * len(AIRLINE_CODES)).cast("int") + 1
        code = F.element_at(F.array(*[F.lit(c) for c in AIRLINE_CODES]), airline_idx)
        ucs = u(k, "cs")
        callsign = (F.when(ucs < 0.02, F.lit(None)).when(ucs < 0.04, F.lit(""))
                     .otherwise(F.concat(code, F.lpad((k % 10000).cast("string"), 4, "0"))))
        dep = add_minutes(F.col("o_orderdate"), F.floor(u(k, "dep") * 1440))
        base = o.select(
            k.alias("vuelo_id"),
            callsign.alias("numero_vuelo"),
            airline_idx.cast("bigint").alias("aerolinea_id"),
            code.alias("codigo_aerolinea"),
            (F.col("o_custkey") % 100).alias("aeronave_id"),
            F.floor(a8 * n_ap).cast("bigint").alias("origen_id"),
            F.floor(b8 * n_ap).cast("bigint").alias("d0"),
            dep.alias("dep_s"),
            k.alias("_k"),
            F.col("o_orderstatus"),
        )
        kk = F.col("_k")
        arr = add_minutes(F.col("dep_s"), F.floor(u(kk, "dur") * 660) + 60)
        ust = u(kk, "st")
        umot = u(kk, "mot")
        return base.select(
            "vuelo_id", "numero_vuelo", "aerolinea_id", "codigo_aerolinea", "aeronave_id", "origen_id",
            F.when(F.col("d0") == F.col("origen_id"), (F.col("d0") + 1) % n_ap)
             .otherwise(F.col("d0")).alias("destino_id"),
            F.col("dep_s").alias("salida_programada"),
            arr.alias("llegada_programada"),
            F.when(u(kk, "rdn") < 0.1, F.lit(None))
             .otherwise(add_minutes(F.col("dep_s"), F.floor(u(kk, "rdep") * 180) - 20)).alias("salida_real"),
            F.when(u(kk, "ran") < 0.3, F.lit(None))
             .otherwise(add_minutes(arr, F.floor(u(kk, "rarr") * 60) - 15)).alias("llegada_real"),
            F.when(ust < 0.03, "CANCEL").when(ust < 0.06, "DIVERTED")
             .when(F.col("o_orderstatus") == "O", "SCHED")
             .when(F.col("o_orderstatus") == "P", "ACTIVE")
             .otherwise("LANDED").alias("estado"),
            F.when(umot < 0.05, "WEATHER").when(umot < 0.08, "TECHNICAL").alias("motivo_desviacion"),
        ).withColumn("salida_real", F.col("salida_real").cast("timestamp_ntz")) \
         .withColumn("llegada_real", F.col("llegada_real").cast("timestamp_ntz"))

    # ---- passengers and bookings ----------------------------------------
    @materialized
    def passengers(self) -> DataFrame:
        c = self.t("customer")
        k = F.col("c_custkey")
        seg = F.col("c_mktsegment")
        return (c.join(F.broadcast(self.nations), c.c_nationkey == F.col("n_nationkey"))
                 .select(
                     k.alias("pasajero_id"),
                     F.replace(F.col("c_name"), F.lit("#"), F.lit(" ")).alias("nombre"),
                     F.concat(F.lit("DOC-"), k.cast("string")).alias("documento"),
                     F.lit("PASSPORT").alias("tipo_documento"),
                     F.col("iso_country").alias("nacionalidad"),
                     F.when(seg == "AUTOMOBILE", "FIRST").when(seg == "BUILDING", "BUSINESS")
                      .when(seg == "FURNITURE", "ECONOMY").when(seg == "HOUSEHOLD", "GOLD")
                      .otherwise("SILVER").alias("categoria"),
                     F.date_sub(F.lit("2000-01-01").cast("date"), F.floor(u(k, "dob") * 15000).cast("int")).alias("fecha_nacimiento"),
                 ))

    @materialized
    def bookings(self) -> DataFrame:
        li = self.t("lineitem")
        pv = F.col("l_orderkey") * 8 + F.col("l_linenumber")
        ub = u(pv, "bst")
        rf = F.col("l_returnflag")
        return li.select(
            pv.alias("pv_id"),
            F.col("l_orderkey").alias("vuelo_id"),
            ((F.col("l_partkey") * 31 + F.col("l_suppkey")) % F.lit(self.n_passengers)).alias("pasajero_id"),
            F.when(rf == "A", "F").when(rf == "R", "J").otherwise("Y").alias("clase"),
            dec(F.col("l_extendedprice"), 12, 2).alias("tarifa_usd"),
            F.when(F.col("l_linestatus") == "F", "BOARDED").when(ub < 0.6, "CONFIRMED")
             .when(ub < 0.9, "CHECKED").otherwise("NOSHOW").alias("estado"),
            F.concat(F.lpad((F.floor(u(pv, "row") * 40) + 1).cast("string"), 2, "0"),
                     pick(["A", "B", "C", "D", "E", "F"], pv, "seat")).alias("asiento"),
            (F.col("l_quantity").cast("int") % 4).alias("equipaje_piezas"),
            dec(F.col("l_quantity"), 8, 2).alias("peso_equipaje_kg"),
            F.col("l_shipdate").alias("fecha_reserva"),
        )

    # ---- cargo, fuel, crew ------------------------------------------------
    @materialized
    def cargo(self) -> DataFrame:
        li, p = self.t("lineitem"), self.t("part")
        awb = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        pt = F.col("p_type")
        decl = F.to_json(F.struct(
            F.col("p_name").alias("commodity"),
            dec(F.col("l_extendedprice"), 12, 2).cast("double").alias("customs_value_usd"),
            (pt == "MEDIUM").alias("dangerous_goods"),
            pick(["AMBIENT", "2-8C", "-18C"], F.col("l_orderkey"), "tmp").alias("temperature_required"),
            F.col("l_linenumber").alias("pieces")))
        return (li.join(p, li.l_partkey == p.p_partkey)
                  .select(
                      awb.alias("awb"),
                      F.col("l_orderkey").alias("vuelo_id"),
                      F.when(pt.isin("ECONOMY", "STANDARD"), "GENERAL").when(pt == "SMALL", "PERECIBLE")
                       .when(pt == "MEDIUM", "PELIGROSA").when(pt == "LARGE", "VALORADA")
                       .when(pt == "PROMO", "ANIMALES").alias("tipo_carga"),
                      dec(F.col("l_quantity") * 20, 10, 2).alias("peso_kg"),
                      dec(F.col("l_quantity") / 2, 10, 2).alias("volumen_m3"),
                      F.when(u(F.col("l_orderkey") * 8 + F.col("l_linenumber"), "decl") < 0.2, F.lit(None))
                       .otherwise(decl).alias("declaracion_json"),
                      F.col("l_shipdate").alias("fecha_carga"),
                  ))

    @materialized
    def fuel(self) -> DataFrame:
        f = self.flights
        k = F.col("vuelo_id")
        litros = dec(u(k, "lit") * 85000 + 3000, 12, 2) * F.when(u(k, "litx") < 0.02, 4).otherwise(1)
        dens = dec(u(k, "den") * 0.06 + 0.78, 6, 3)
        price = dec(u(k, "pre") * 0.2 + 0.75, 8, 4)
        return (f.filter(u(k, "fuel") >= 0.2)
                 .select(
                     k.alias("fuel_id"), k,
                     F.col("origen_id").alias("aeropuerto_id"),
                     dec(litros, 12, 2).alias("litros"),
                     dens.alias("densidad_kgl"),
                     dec(litros * dens * F.when(u(k, "masx") < 0.02, 2).otherwise(1), 14, 3).alias("masa_kg"),
                     price.alias("precio_litro_usd"),
                     dec(litros * price, 14, 2).alias("costo_total_usd"),
                     add_minutes(F.col("salida_programada"), F.lit(-45)).alias("timestamp_carga"),
                 ))

    @materialized
    def crew(self) -> DataFrame:
        li = self.t("lineitem")
        r = F.col("l_orderkey") * 8 + F.col("l_linenumber")
        roles = F.array(*[F.lit(x) for x in ["CAPTAIN", "FIRST_OFFICER", "RELIEF_PILOT", "PURSER",
                                             "CABIN_CREW", "LOADMASTER"]])
        short = F.when(((F.col("l_suppkey") % 3) == 0) & (u(r, "short") < 0.05), 4.5).otherwise(0.0)
        return li.select(
            r.alias("roster_id"),
            F.col("l_orderkey").alias("vuelo_id"),
            F.col("l_suppkey").alias("crew_id"),
            F.try_element_at(roles, F.col("l_linenumber")).alias("rol"),
            add_minutes(F.col("l_shipdate"), F.floor(u(r, "rep") * 1440)).alias("report_time"),
            dec(u(r, "duty") * 14 + 1, 5, 2).alias("duty_hours"),
            dec(u(r, "rest") * 4 + 10 - short, 5, 2).alias("descanso_horas"),
            F.lit(10).alias("descanso_minimo"),
        )

    # ---- event-derived streams --------------------------------------------
    @materialized
    def positions(self) -> DataFrame:
        return self.positions_from(self.t("events"))

    @staticmethod
    def positions_from(e: DataFrame) -> DataFrame:
        """Positions from an events frame (batch or streaming)."""
        k = F.col("event_id")
        return e.select(
            k.alias("posicion_id"),
            F.col("user_id").alias("vuelo_id"),
            F.col("ts").alias("timestamp_utc"),
            dec(u(k, "plat") * 170 - 85, 9, 6).alias("latitud"),
            dec(u(k, "plon") * 360 - 180, 9, 6).alias("longitud"),
            F.when(u(k, "altn") < 0.1, F.lit(None)).otherwise(dec(u(k, "alt") * 40000, 8, 2)).alias("altitud_pies"),
            F.col("value").alias("velocidad_nudos"),
            dec(u(k, "hdg") * 360, 5, 2).alias("heading"),
            dec(u(k, "dev") * 60, 5, 2).alias("desviacion_nm"),
            (F.col("user_id") % 75).alias("aerovia_id"),
        )

    @materialized
    def sensors(self) -> DataFrame:
        return self.sensors_from(self.t("events"))

    @staticmethod
    def sensors_from(e: DataFrame) -> DataFrame:
        """Engine readings from an events frame (batch or streaming)."""
        k = F.col("event_id")
        eng = F.col("user_id") % 50

        def nul(c, salt):
            return F.when(u(k, salt) < 0.05, F.lit(None)).otherwise(c)

        return e.select(
            k.alias("sensor_id"),
            F.concat(F.lit("ENG-"), F.lpad(eng.cast("string"), 2, "0")).alias("engine_id"),
            nul(dec(u(k, "n1") * 95 + 20, 6, 2), "n1n").alias("n1_pct"),
            nul(dec(u(k, "n2") * 85 + 30, 6, 2), "n2n").alias("n2_pct"),
            nul(dec(u(k, "egt") * 500 + 350 + F.when(eng % 10 == 0, 350).otherwise(0), 7, 2), "egtn").alias("egt_c"),
            nul(dec(dec(F.col("value"), 12, 2) * 10, 10, 2), "ffn").alias("fuel_flow_kgh"),
            nul(dec(dec(F.col("value"), 12, 2) * F.lit(0.05).cast("decimal(3,2)") + F.when(eng % 10 == 1, 5).otherwise(0), 8, 3), "vibn").alias("vibration"),
            F.col("ts").alias("timestamp_utc"),
        )

    @materialized
    def baggage(self) -> DataFrame:
        return self.baggage_from(self.t("events"))

    @staticmethod
    def baggage_from(e: DataFrame) -> DataFrame:
        """Bag events from an events frame (batch or streaming)."""
        k = F.col("event_id")
        et = F.col("event_type")
        ev = (F.when(et == "signup", "CHECKIN").when(et == "view", "LOAD").when(et == "click", "TRANSFER")
               .when(et == "purchase", "UNLOAD").when(et == "error", "LOST"))
        return e.select(
            k.alias("baggage_id"),
            F.concat(F.lit("BG"), F.lpad(F.col("user_id").cast("string"), 4, "0")).alias("tag_id"),
            F.col("user_id").alias("vuelo_id"),
            F.lpad((F.col("user_id") % 100).cast("string"), 4, "0").alias("aeropuerto"),
            F.when(u(k, "bev") < 0.03, F.lit(None)).otherwise(ev).alias("evento"),
            F.col("ts").alias("timestamp_utc"),
        )

    @materialized
    def maintenance(self) -> DataFrame:
        e = self.t("events")
        k = F.col("event_id")
        et = F.col("event_type")
        act = (F.when(et == "view", "INSPECTION").when(et == "click", "CLEANING")
                .when(et == "purchase", "REPAIR").when(et == "signup", "REPLACEMENT")
                .when(u(k, "ovh") < 0.5, "OVERHAUL").otherwise("TEST"))
        ust = u(k, "mst")
        return e.select(
            k.alias("evento_id"),
            (F.col("user_id") % 100).alias("aeronave_id"),
            pick(["ENGINE", "APU", "LANDING_GEAR", "AVIONICS", "HYDRAULICS", "FUEL_SYSTEM",
                  "CABIN", "BRAKES"], k, "comp").alias("componente"),
            F.when(u(k, "acn") < 0.04, F.lit(None)).otherwise(act).alias("accion"),
            pick(["BOG", "LAX", "MAD", "MIA", "PTY", "SJO", "XXX"], k, "taller").alias("taller_codigo"),
            F.when(u(k, "tecf") < 0.1, F.lit("TECH-ABC"))
             .otherwise(F.concat(F.lit("TECH-"), F.lpad((k % 1000).cast("string"), 3, "0"))).alias("tecnico_id"),
            dec(u(k, "hrs") * 60000, 10, 2).alias("horas_aeronave"),
            F.col("ts").alias("timestamp_utc"),
            F.when(ust < 0.75, "CLOSED").when(ust < 0.90, "INPROGRESS").when(ust < 0.97, "OPEN")
             .otherwise("DEFERRED").alias("estado"),
        )

    # ---- reservations / boarding (bronze-shaped, JSON columns) ------------
    @materialized
    def reservations(self) -> DataFrame:
        c = self.t("customer")
        k = F.col("c_custkey")
        ok = k * 10
        code = F.element_at(F.array(*[F.lit(x) for x in AIRLINE_CODES]),
                            F.floor(u(ok, "airline") * len(AIRLINE_CODES)).cast("int") + 1)
        pax = F.to_json(F.struct(
            F.split_part(F.col("c_name"), F.lit("#"), F.lit(1)).alias("first_name"),
            F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)).alias("last_name"),
            F.when(u(k, "dtn") < 0.1, F.lit(None)).otherwise(F.lit("PASSPORT")).alias("document_type"),
            F.when(u(k, "natn") < 0.05, F.lit(None)).otherwise(F.col("iso_country")).alias("nationality"),
            (u(k, "ff") < 0.2).alias("frequent_flyer")), {"ignoreNullFields": "false"})
        vuelos = F.to_json(F.struct(
            F.concat(code, F.lpad((ok % 10000).cast("string"), 4, "0")).alias("flight_number"),
            F.lpad((ok % 97).cast("string"), 4, "0").alias("origin"),
            F.lpad((ok % 89).cast("string"), 4, "0").alias("destination"),
            code.alias("airline")))
        return (c.join(F.broadcast(self.nations), c.c_nationkey == F.col("n_nationkey"))
                 .select(
                     k.alias("reserva_id"),
                     F.when(u(k, "pnrn") < 0.05, F.lit(None))
                      .otherwise(F.upper(F.substring(F.md5(k.cast("string")), 1, 6))).alias("pnr"),
                     pax.alias("pasajero_json"),
                     vuelos.alias("vuelos_json"),
                     F.when(u(k, "clsn") < 0.03, F.lit(None))
                      .otherwise(pick(["F", "C", "W", "Y", "J"], k, "cls")).alias("clase"),
                     F.when(u(k, "farn") < 0.06, F.lit(None))
                      .otherwise(dec(u(k, "far") * 1800 + 200, 10, 2)).alias("tarifa_usd"),
                     F.when(u(k, "estn") < 0.03, F.lit(None))
                      .otherwise(pick(["CONFIRMED", "CANCELLED", "CHECKED", "NOSHOW"], k, "est")).alias("estado"),
                     add_minutes(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
                                 F.floor(u(k, "rts") * 43200)).alias("timestamp_utc"),
                 ))

    @materialized
    def boarding(self) -> DataFrame:
        c = self.t("customer")
        k = F.col("c_custkey")
        seq = F.explode(F.sequence(F.lit(0), F.when(u(k, "two") < 0.2, 1).otherwise(0)))
        base = c.filter(u(k, "brd") < 0.6).select(k, seq.alias("seq"))
        bid = F.col("c_custkey") * 2 + F.col("seq")
        return base.select(
            bid.alias("boarding_id"),
            F.when(u(k, "pnrn") < 0.05, F.lit(None))
             .otherwise(F.upper(F.substring(F.md5(k.cast("string")), 1, 6))).alias("pnr"),
            (k * 10).cast("string").alias("vuelo_id"),
            F.when(u(bid, "seatn") < 0.05, F.lit(None))
             .otherwise(F.concat(F.lpad((F.floor(u(bid, "row") * 40) + 1).cast("string"), 2, "0"),
                                 pick(["A", "B", "C", "D", "E", "F"], bid, "seat"))).alias("asiento"),
            F.concat(F.lit("G"), (F.floor(u(bid, "gate") * 30) + 1).cast("string")).alias("gate"),
            F.when(u(bid, "tsn") < 0.05, F.lit(None))
             .otherwise(add_minutes(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"),
                                    F.floor(u(k, "rts") * 43200) + 1440 + F.col("seq") * 10)).alias("timestamp_utc"),
        )

    # ---- navigation -------------------------------------------------------
    @materialized
    def navaids(self) -> DataFrame:
        p = self.t("part")
        k = F.col("p_partkey")
        return p.select(
            k.alias("id"),
            F.concat(F.lit("navaids_"), (k % 7).cast("string"), F.lit(".csv")).alias("filename"),
            F.substring(F.upper(F.replace(F.col("p_name"), F.lit(" "), F.lit(""))), 1, 10).alias("ident"),
            F.col("p_name").alias("name"),
            pick(["VOR", "VOR-DME", "DME", "NDB", "NDB-DME", "TACAN", "INT", "XYZ"], k, "ntype").alias("type"),
            (F.col("p_size").cast("bigint") * 10 - 50).alias("frequency_khz"),
            F.when(u(k, "nlatn") < 0.05, F.lit(None)).otherwise(dec(u(k, "nlat") * 170 - 85, 12, 8)).alias("latitude_deg"),
            dec(u(k, "nlon") * 360 - 180, 12, 8).alias("longitude_deg"),
            F.floor(u(k, "nelev") * 5000).cast("int").alias("elevation_ft"),
            F.col("p_brand").alias("iso_country"),
            F.col("p_type").alias("iso_region"),
            (F.col("p_size").cast("bigint") * 3 - 20).alias("dme_frequency_khz"),
            F.concat(F.lit("CH"), F.col("p_size").cast("string"), F.lit("XXXXXXXXXX")).alias("dme_channel"),
        )

    @materialized
    def airways(self) -> DataFrame:
        p = self.t("part")
        k = F.col("p_partkey")
        lat1 = dec(u(k, "wlat") * 120 - 60, 9, 6)
        lon1 = dec(u(k, "wlon") * 340 - 170, 9, 6)
        return p.select(
            k.alias("aerovia_id"),
            F.concat(pick(["UL", "UM", "UN", "UT", "UA"], k, "wcode"), k.cast("string")).alias("codigo"),
            lat1.alias("lat1"), lon1.alias("lon1"),
            dec(lat1 + dec(u(k, "wdlat") * 20 - 10, 9, 6), 9, 6).alias("lat2"),
            dec(lon1 + dec(u(k, "wdlon") * 20 - 10, 9, 6), 9, 6).alias("lon2"),
            (F.floor(u(k, "flmin") * 200) + 50).cast("int").alias("nivel_min"),
            (F.floor(u(k, "flmax") * 200) + 250).cast("int").alias("nivel_max"),
        )

    @materialized
    def notams(self) -> DataFrame:
        p = self.t("part")
        k = F.col("p_partkey")
        desde = add_minutes(F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), F.floor(u(k, "nd") * 43200))
        return p.select(
            k.alias("notam_id"),
            F.concat(pick(["A", "B", "C", "D", "E"], k, "nl"),
                     F.lpad(k.cast("string"), 4, "0"), F.lit("/24")).alias("ident"),
            ((k * 7) % F.lit(self.n_airports)).alias("aeropuerto_id"),
            pick(["N", "D", "R", "C"], k, "nt").alias("tipo"),
            F.floor(u(k, "rad") * 50).cast("int").alias("radio_nm"),
            F.floor(u(k, "hmin") * 5000).cast("int").alias("altura_min"),
            desde.alias("valido_desde"),
            F.timestamp_add("DAY", (F.floor(u(k, "nv") * 30) + 1).cast("bigint"), desde).alias("valido_hasta"),
        )

    @cached_property
    def airway_points(self) -> DataFrame:
        """Positions drawn near an airway (jitter of +-0.3 degrees)."""
        e = self.t("events")
        k = F.col("event_id")
        w = self.airways.select("aerovia_id", "lat1", "lon1", "lat2", "lon2", "nivel_min", "nivel_max")
        pts = e.select(k.alias("punto_id"), (F.col("user_id") % 75).alias("aerovia_id"),
                       u(k, "frac").alias("f"), u(k, "jlat").alias("jl"), u(k, "jlon").alias("jo"),
                       dec(u(k, "jalt") * 45000, 8, 2).alias("altitud_pies"))
        j = pts.join(w, "aerovia_id")
        return j.select(
            "punto_id", "aerovia_id",
            dec(F.col("lat1") + F.col("f") * (F.col("lat2") - F.col("lat1")) + (F.col("jl") * 0.6 - 0.3), 9, 6).alias("latitud"),
            dec(F.col("lon1") + F.col("f") * (F.col("lon2") - F.col("lon1")) + (F.col("jo") * 0.6 - 0.3), 9, 6).alias("longitud"),
            "altitud_pies")

    # ---- rule inputs and snapshots ----------------------------------------
    @materialized
    def rule_inputs(self) -> DataFrame:
        return self.rule_inputs_from(self.t("lineitem"))

    @staticmethod
    def rule_inputs_from(li: DataFrame) -> DataFrame:
        """KPI rule inputs from a lineitem frame (batch or streaming)."""
        r = F.col("l_orderkey") * 8 + F.col("l_linenumber")
        return li.select(
            r.alias("registro_id"),
            F.col("l_orderkey").alias("vuelo_id"),
            dec(F.col("l_quantity") * 2.2 - 3, 8, 2).alias("load_factor_pct"),
            dec(F.col("l_discount") + 0.03, 8, 4).alias("efficiency_kg_km"),
            dec(u(r, "var") * 30 - 15, 8, 2).alias("variation_pct"),
            dec(u(r, "saf") * 108 - 4, 8, 2).alias("saf_pct"),
            dec(F.col("l_extendedprice") - 3000, 14, 2).alias("revenue_usd"),
        )

    @cached_property
    def snapshot_old(self) -> DataFrame:
        f = self.flights
        return f.filter(u(F.col("vuelo_id"), "snap_add") >= 0.02)

    @cached_property
    def snapshot_new(self) -> DataFrame:
        f = self.flights
        k = F.col("vuelo_id")
        return (f.filter(u(k, "snap_del") >= 0.02)
                 .withColumn("estado", F.when(u(k, "snap_upd") < 0.05,
                                              pick(["ACTIVE", "LANDED", "DIVERTED"], k, "snap_st"))
                             .otherwise(F.col("estado"))))
