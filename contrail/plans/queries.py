"""Registered queries: one function per SURVEY §2 query key.

Each takes a ``Layers`` object and returns the result DataFrame. Output
columns are named to match the DuckDB oracle; measures are reported as
doubles rounded to a fixed scale (trap T14).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions.conform import money
from contrail.plans.context import Layers

REGISTRY: dict = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _dbl(df: DataFrame) -> DataFrame:
    """Cast every decimal column to double for reporting."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
                       for c, t in df.dtypes])


# ---- gold dimensions ----------------------------------------------------------
@query
def dim_calendar(L: Layers) -> DataFrame:
    return L.dim_calendar


@query
def dim_airport(L: Layers) -> DataFrame:
    return _dbl(L.dim_airport)


@query
def dim_route(L: Layers) -> DataFrame:
    return L.dim_route


@query
def dim_aircraft(L: Layers) -> DataFrame:
    """K3 through A11: truncate-and-reload twice into one table (the rerun replaces, never appends)."""
    import uuid

    from contrail.operators.sinks import truncate_reload
    from contrail.session import scratch_path
    path = scratch_path(L.spark, f"warehouse/dim_aeronave-{uuid.uuid4().hex}")
    truncate_reload(L.dim_aircraft, path)
    return truncate_reload(L.dim_aircraft, path)


@query
def fact_flight(L: Layers) -> DataFrame:
    return _dbl(L.fact_flight_raw.drop("salida_programada"))


@query
def fact_flight_enrich(L: Layers) -> DataFrame:
    return _dbl(L.fact_flight.select("vuelo_id", "asientos_ofrecidos", "asientos_vendidos", "pax_transportados",
                                     "pax_no_show", "passenger_revenue_usd", "total_revenue_usd"))


@query
def otp_by_month(L: Layers) -> DataFrame:
    hv = L.fact_flight.select("tiempo_id", "delay_min")
    t = L.dim_calendar.select("tiempo_id", "anio", "mes")
    on_time = F.sum(F.when(F.col("delay_min") <= 15, 1).otherwise(0))
    return (hv.join(t, "tiempo_id").groupBy("anio", "mes")
              .agg(F.count("*").alias("vuelos_totales"), on_time.alias("vuelos_puntuales"),
                   F.round(on_time.cast("decimal(20,6)") / F.count("*") * 100, 2).cast("double").alias("otp_pct")))


@query
def fact_flight_totals(L: Layers) -> DataFrame:
    hv = L.fact_flight
    return hv.agg(
        F.count("*").alias("total_vuelos"),
        F.sum("asientos_ofrecidos").alias("total_asientos_ofrecidos"),
        F.sum("pax_transportados").alias("total_pax"),
        F.round(F.sum("pax_transportados").cast("decimal(20,6)")
                / F.when(F.sum("asientos_ofrecidos") != 0, F.sum("asientos_ofrecidos")) * 100, 2).cast("double")
         .alias("load_factor_global"),
        money(F.sum("passenger_revenue_usd")).alias("revenue_pax_total"),
        money(F.sum("cargo_revenue_usd")).alias("revenue_cargo_total"),
        money(F.sum("total_revenue_usd")).alias("revenue_total"),
        money(F.sum("co2_emitted_ton")).alias("co2_total_ton"),
        F.count("delay_code").alias("vuelos_con_delay"))


# ---- silver pipelines (J*) -----------------------------------------------------
from contrail.plans import silver as _s  # noqa: E402


@query
def clean_airlines(L: Layers) -> DataFrame:
    return _s.clean_airlines(L.fx.flights)


@query
def clean_flights(L: Layers) -> DataFrame:
    return _s.clean_flights(L.fx.flights, L.fx.airports, L.airlines)


@query
def clean_passengers(L: Layers) -> DataFrame:
    return _s.clean_passengers(L.fx.reservations)


@query
def booking_resolve(L: Layers) -> DataFrame:
    return _s.booking_resolve(L.fx.reservations, L.fx.passengers, L.fx.flights, L.fx.boarding)


@query
def baggage_latest(L: Layers) -> DataFrame:
    return L.baggage


@query
def clean_cargo(L: Layers) -> DataFrame:
    return _dbl(L.cargo)


@query
def cargo_enrich(L: Layers) -> DataFrame:
    return _dbl(_s.cargo_enrich(L.cargo))


@query
def clean_crew(L: Layers) -> DataFrame:
    return _dbl(L.crew)


@query
def crew_quarantine(L: Layers) -> DataFrame:
    """M5: duties kept from landing, with the rule that rejected them."""
    return _dbl(_s.crew_quarantine(L.crew_judged))


@query
def synth_fleet(L: Layers) -> DataFrame:
    ids = L.fx.t("orders").select((F.col("o_custkey") % 100).alias("aeronave_id")).distinct()
    return _s.synth_fleet(ids)


@query
def inline_values_anti_insert(L: Layers) -> DataFrame:
    return _s.inline_values_anti_insert(L.spark, L.fleet)


@query
def fallback_lookup(L: Layers) -> DataFrame:
    return L.workshops.drop("iata_code")


@query
def engines_cross(L: Layers) -> DataFrame:
    return L.engines


@query
def first_child_by_order(L: Layers) -> DataFrame:
    return _s.first_child_by_order(L.engines)


@query
def clean_maintenance(L: Layers) -> DataFrame:
    return _dbl(L.maintenance)


@query
def clean_fuel(L: Layers) -> DataFrame:
    return _dbl(_s.clean_fuel(L.fuel_landed, L.fx.flights, L.fx.airports))


@query
def clean_positions(L: Layers) -> DataFrame:
    return L.positions


@query
def clean_sensors(L: Layers) -> DataFrame:
    return _dbl(L.sensors)


@query
def clean_waypoints(L: Layers) -> DataFrame:
    out = _s.clean_waypoints(L.fx.navaids)
    return _dbl(out.select(*[c for c in out.columns if c != "ubicacion"],
                           F.col("ubicacion.lon").alias("pt_lon"), F.col("ubicacion.lat").alias("pt_lat"),
                           F.col("ubicacion.z").alias("pt_z")))


@query
def airport_fk_enrich(L: Layers) -> DataFrame:
    out = _s.airport_fk_enrich(L.fx.airports, L.fx.countries, L.fx.regions)
    return out.select("aeropuerto_id", "ident", "iso_country", "iso_region", "country_id", "region_id",
                      F.col("ubicacion.lon").alias("lon"), F.col("ubicacion.lat").alias("lat"))
