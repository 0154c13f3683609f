"""Lazy wiring of the medallion layers over one scale-factor folder.

``Layers`` builds every silver and gold DataFrame on first use. The
silver tables many queries read (flights, bookings, positions, ...), the
dimensions and every gold fact go through ``keep``: written once per
application to the shared
checkpoint folder -- the medallion's silver/gold tables -- and read from
there by every later query, instead of being re-derived in each branch of
each plan.
"""

from __future__ import annotations

import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.operators.months import MONTH, MonthLayout
from contrail.plans import gold, silver
from contrail.session import configure, scratch_path, write_table
from contrail.sources.fixtures import Fixtures

#: K10 cut-off for the driver's bookings: they average 4 a flight, where the default of 50 suits full flights.
BOOKINGS_ENRICH_BELOW = 3

#: Months the gold facts have partitions for; other and missing dates go to the default partition.
FACT_MONTHS = MonthLayout(199501, 202612)

# Layers written once per (application, input folder): the silver and gold
# tables of the medallion, as Parquet in the shared folder.
_STORE: dict[tuple, DataFrame] = {}
_GUARD = threading.Lock()
_KEY_LOCKS: dict[tuple, threading.Lock] = {}

# Build order for ``Layers.build``: tables in one stage depend only on
# earlier stages, so each stage's jobs can run concurrently.
BUILD_STAGES = [
    ["fx.flights", "fx.airports", "fx.aircraft", "fx.bookings", "fx.cargo", "fx.passengers", "fx.positions",
     "fx.sensors", "fx.maintenance", "fx.crew", "fx.notams", "fx.airways", "fx.navaids", "fx.reservations",
     "fx.boarding", "fx.baggage", "fx.rule_inputs"],
    ["fx.fuel", "dim_calendar", "dim_airport", "dim_aircraft", "dim_segment", "engines", "workshops", "crew_judged",
     "positions", "cargo"],
    ["dim_route", "maintenance", "fuel_all"],
    ["flight_routes", "fact_crew"],
    ["fact_flight_raw", "fact_cargo", "fact_maintenance"],
    ["fact_flight"],
    ["fact_passenger_raw", "fact_fuel"],
    ["fact_passenger"],
]


class Layers:
    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool = True):
        configure(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self.materialize = materialize
        self.fx = Fixtures(spark, sf_dir, keep=self.keep if materialize else None)
        self._by_month: dict[str, DataFrame] = {}

    def keep(self, name: str, build, layout: MonthLayout | None = None) -> DataFrame:
        """Write the table ``build()`` returns once to the shared checkpoint folder and reuse it.

        ``build`` is only called when the table is not written yet, so a
        query that finds its inputs written never re-plans them.

        A table read by many queries (flights, the flight fact, ...) is
        computed once; later plans start from durable files, so a lost
        executor recomputes from them instead of from the raw tables. With a
        ``layout`` the table is partitioned by month and has its month column.
        """
        if not self.materialize:
            return build() if layout is None else layout.with_month(build())
        key = (self.spark.sparkContext.applicationId, self.sf_dir, name)
        with _GUARD:
            lock = _KEY_LOCKS.setdefault(key, threading.Lock())
        with lock:  # one writer per table even when stages run in threads
            if key not in _STORE:
                _STORE[key] = (write_table(build(), name) if layout is None else
                               layout.write(build(), scratch_path(self.spark, f"tables/{name}-{uuid.uuid4().hex}")))
        return _STORE[key]

    def _fact(self, name: str, build) -> DataFrame:
        """A gold fact, kept by month, without its partition column."""
        self._by_month[name] = self.keep(name, build, FACT_MONTHS)
        return self._by_month[name].drop(MONTH)

    def months(self, name: str) -> DataFrame:
        """The fact ``name`` with its partition column, for reads pruned by month."""
        getattr(self, name)
        return self._by_month[name]

    def build(self, threads: int = 8) -> None:
        """Write every shared table, stage by stage; jobs within a stage run concurrently."""
        def touch(path: str) -> None:
            obj = self
            for part in path.split("."):
                obj = getattr(obj, part)

        for stage in BUILD_STAGES:
            with ThreadPoolExecutor(max_workers=threads) as ex:
                list(ex.map(touch, stage))

    # ---- silver -----------------------------------------------------------
    @cached_property
    def airlines(self) -> DataFrame:
        return silver.airline_dim(self.spark)

    @cached_property
    def fleet(self) -> DataFrame:
        return self.fx.aircraft

    @cached_property
    def engines(self) -> DataFrame:
        return self.keep("engines", lambda: silver.engines_cross(self.spark, self.fleet))

    @cached_property
    def workshops(self) -> DataFrame:
        return self.keep("workshops", lambda: silver.workshops(self.spark, self.fx.airports))

    @cached_property
    def crew_judged(self) -> DataFrame:
        return self.keep("crew_judged", lambda: silver.judged_crew(self.fx.crew, self.fx.flights))

    @cached_property
    def crew(self) -> DataFrame:
        return silver.clean_crew(self.crew_judged)

    @cached_property
    def maintenance(self) -> DataFrame:
        return self.keep("maintenance", lambda: silver.clean_maintenance(self.fx.maintenance, self.fleet, self.engines, self.workshops))

    @cached_property
    def positions(self) -> DataFrame:
        return self.keep("positions", lambda: silver.clean_positions(self.fx.positions, self.fx.flights))

    @cached_property
    def sensors(self) -> DataFrame:
        return silver.clean_sensors(self.fx.sensors)

    @cached_property
    def baggage(self) -> DataFrame:
        return silver.baggage_latest(self.fx.baggage, self.fx.flights)

    @cached_property
    def cargo(self) -> DataFrame:
        return self.keep("cargo", lambda: silver.clean_cargo(self.fx.cargo, self.fx.flights))

    # ---- gold dims -----------------------------------------------------------
    @cached_property
    def dim_calendar(self) -> DataFrame:
        dates = (self.fx.flights.select(F.col("salida_programada").alias("ts"))
                 .unionByName(self.fx.t("events").select("ts")))
        return self.keep("dim_calendar", lambda: gold.dim_calendar(dates))

    @cached_property
    def dim_airport(self) -> DataFrame:
        return self.keep("dim_airport", lambda: gold.dim_airport(self.fx.airports, self.fx.flights))

    @cached_property
    def dim_route(self) -> DataFrame:
        return self.keep("dim_route", lambda: gold.dim_route(self.fx.flights, self.dim_airport))

    @cached_property
    def dim_aircraft(self) -> DataFrame:
        return self.keep("dim_aircraft", lambda: gold.dim_aircraft(self.fleet))

    @cached_property
    def dim_segment(self) -> DataFrame:
        return self.keep("dim_segment", lambda: gold.dim_passenger_segment(self.fx.passengers))

    @cached_property
    def dim_crew_role(self) -> DataFrame:
        return gold.dim_crew_role(self.spark)

    # ---- gold facts ----------------------------------------------------------
    @cached_property
    def fuel_landed(self) -> DataFrame:
        return silver.landing_fuel(self.fx.fuel)

    @cached_property
    def fuel_all(self) -> DataFrame:
        """Landed silver fuel plus the K7 backfill for flights without fuel."""
        f = self.fuel_landed
        cols = ["vuelo_id", "aeropuerto_id", "litros", "densidad_kgl", "masa_kg", "precio_litro_usd",
                "costo_total_usd", "timestamp_carga"]
        bf = gold.fuel_backfill(self.fx.flights, f).select(*cols)
        return self.keep("fuel_all", lambda: f.select(F.col("fuel_id"), *cols)
                         .unionByName(bf.withColumn("fuel_id", -F.col("vuelo_id") - 1)))

    @cached_property
    def flight_routes(self) -> DataFrame:
        return self.keep("flight_routes", lambda: gold.flight_routes(
            self.fx.flights, self.dim_airport, self.dim_route, self.dim_calendar))

    @cached_property
    def fact_flight_raw(self) -> DataFrame:
        return self.keep("fact_flight_raw", lambda: gold.fact_flight(
            self.fx.flights, self.fleet, self.dim_airport, self.dim_route, self.dim_aircraft, self.dim_calendar,
            self.fx.bookings, self.cargo, self.fuel_all, routes=self.flight_routes))

    @cached_property
    def fact_flight(self) -> DataFrame:
        return self._fact("fact_flight", lambda: gold.fact_flight_enrich(
            self.fact_flight_raw, below=BOOKINGS_ENRICH_BELOW))

    @cached_property
    def fact_passenger_raw(self) -> DataFrame:
        return self.keep("fact_passenger_raw", lambda: gold.fact_passenger(
            self.fx.bookings, self.fact_flight, self.dim_segment))

    @cached_property
    def fact_passenger(self) -> DataFrame:
        return self._fact("fact_passenger", lambda: gold.fact_passenger_yield_fill(self.fact_passenger_raw))

    @cached_property
    def fact_cargo(self) -> DataFrame:
        return self._fact("fact_cargo", lambda: gold.fact_cargo(
            self.cargo, self.fx.flights, self.dim_airport, self.dim_route, self.dim_calendar,
            routes=self.flight_routes))

    @cached_property
    def fact_fuel(self) -> DataFrame:
        return self._fact("fact_fuel", lambda: gold.fact_fuel(
            self.fuel_all, self.fx.flights, self.dim_airport, self.dim_aircraft, self.dim_route, self.dim_calendar,
            self.fact_flight, routes=self.flight_routes))

    @cached_property
    def fact_maintenance(self) -> DataFrame:
        return self._fact("fact_maintenance", lambda: gold.fact_maintenance(
            self.maintenance, self.dim_aircraft, self.dim_calendar))

    @cached_property
    def fact_crew(self) -> DataFrame:
        return self._fact("fact_crew", lambda: gold.fact_crew(
            self.crew, self.fx.flights, self.dim_crew_role, self.dim_calendar))
