"""The monthly marts V13, V14, V17 and V18 kept up by changed months.

Each query stores a fact in which one month is incomplete, builds the mart, loads that month again
and refreshes: the mart then equals the view over the whole fact, though only one month was read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.operators.marts import Measures, MonthlyMart, mean
from contrail.plans.context import FACT_MONTHS, Layers
from contrail.plans.queries import query
from contrail.plans.views import _r
from contrail.session import scratch_path

_MONTH = 199706
_KM = "cast(distance_flown_km as decimal(14,2))"


def _dated(L: Layers):
    days = L.dim_calendar.select("tiempo_id", "anio", "mes")
    return lambda fact: fact.join(days, "tiempo_id")


def occupancy_measures(L: Layers) -> Measures:
    return Measures(("ruta_id", "anio", "mes"), {
        "asientos_ofrecidos": "asientos_ofrecidos", "asientos_vendidos": "asientos_vendidos", "pasajeros_transportados": "pax_transportados",
        "km": _KM, "ask": f"asientos_ofrecidos * {_KM}", "rpk": f"pax_transportados * {_KM}",
        "passenger_revenue_usd": "passenger_revenue_usd", "total_revenue_usd": "total_revenue_usd"}, {"vuelos_operados": "vuelo_id"}, _dated(L))


def otp_measures(L: Layers) -> Measures:
    return Measures(("ruta_id", "anio", "mes"), {"delay": "cast(delay_min as decimal(18,0))", "revenue": "total_revenue_usd", "co2": "co2_emitted_ton"}, {
        "vuelos_totales": "vuelo_id", "n_delay": "delay_min", "vuelos_puntuales": "if(delay_min <= 15, 1, null)",
        "vuelos_demorados": "if(delay_min > 15, 1, null)"}, _dated(L))


def fuel_measures(L: Layers) -> Measures:
    return Measures(("aeronave_id", "anio", "mes"), {
        "kg": "cast(fuel_consumed_kg as decimal(18,6))", "usd": "cast(fuel_cost_total_usd as decimal(18,6))", "eff": "cast(efficiency_kg_km as decimal(18,4))",
        "co2": "cast(co2_per_pax_km as decimal(18,4))", "saf": "cast(alternative_fuel_pct as decimal(18,2))"}, {
        "total_operaciones": "1", "n_eff": "efficiency_kg_km", "n_co2": "co2_per_pax_km", "n_saf": "alternative_fuel_pct"}, _dated(L))


def cargo_measures(L: Layers) -> Measures:
    return Measures(("ruta_id", "anio", "mes"), {
        "kg": "cast(cargo_weight_kg as decimal(18,6))", "m3": "cast(cargo_volume_m3 as decimal(18,6))", "usd": "cast(cargo_revenue_usd as decimal(18,6))", "yield": "cast(yield_usd_kgkm as decimal(18,4))",
        "carga_perecible": "perishable_count", "carga_peligrosa": "dangerous_goods_count", "retenciones_aduana": "customs_hold_count"}, {
        "total_envios": "1", "n_yield": "yield_usd_kgkm"}, _dated(L))


def _refreshed(L: Layers, name: str, measures: Measures, missing: Column) -> DataFrame:
    path = scratch_path(L.spark, f"warehouse/mv-{name}-{uuid.uuid4().hex}")
    fact = getattr(L, name)
    month = F.col("tiempo_id").between(_MONTH * 100 + 1, _MONTH * 100 + 31)
    stored = FACT_MONTHS.write(fact.where(~F.coalesce(month & missing, F.lit(False))), f"{path}/hechos")
    mart = MonthlyMart(L.spark, f"{path}/mv", FACT_MONTHS, measures)
    mart.refresh(stored, f"{path}/hechos")
    stored = FACT_MONTHS.reload(fact, f"{path}/hechos", [_MONTH])
    mart.refresh(stored, f"{path}/hechos")
    return mart.read(stored)


@query
def mv_months_occupancy(L: Layers) -> DataFrame:
    """Route occupancy after one month of the flight fact was loaded again."""
    m = occupancy_measures(L)
    r = L.dim_route.select("ruta_id", "origen_icao", "destino_icao", "tipo_ruta", "mercado")
    keys = ("ruta_id", "origen_icao", "destino_icao", "tipo_ruta", "mercado", "anio", "mes")
    g = m.merge(_refreshed(L, "fact_flight", m, F.col("delay_min") > 15).join(r, "ruta_id"), *keys)
    ask, rpk = (F.col(c).cast("decimal(28,2)") for c in ("ask", "rpk"))
    pax = F.col("passenger_revenue_usd").cast("decimal(28,2)")
    return g.select(*keys, "vuelos_operados", "asientos_ofrecidos", "asientos_vendidos", "pasajeros_transportados",
                    _r(F.col("km")).alias("distancia_total_km"), _r(ask).alias("ask_total"), _r(rpk).alias("rpk_total"),
                    _r(rpk * 100 / F.when(ask != 0, ask)).alias("load_factor_pct"), _r(pax).alias("passenger_revenue_usd"),
                    _r(F.col("total_revenue_usd")).alias("total_revenue_usd"), _r(pax / F.when(rpk != 0, rpk), 4).alias("yield_usd_rpk"))


@query
def mv_months_otp(L: Layers) -> DataFrame:
    """Punctuality by airport after one month of the flight fact was loaded again."""
    m = otp_measures(L)
    r = L.dim_route.select("ruta_id", "origen_icao")
    da = L.dim_airport.select("aeropuerto_id", "iata", F.col("icao").alias("origen_icao"), F.col("nombre").alias("aeropuerto_nombre"), "ciudad", "pais")
    rows = _refreshed(L, "fact_flight", m, F.col("delay_min") > 15).join(r, "ruta_id").join(da, "origen_icao").withColumnRenamed("origen_icao", "icao")
    keys = ("aeropuerto_id", "iata", "icao", "aeropuerto_nombre", "ciudad", "pais", "anio", "mes")
    return m.merge(rows, *keys).select(
        *keys, "vuelos_totales", "vuelos_puntuales", "vuelos_demorados",
        _r(F.col("vuelos_puntuales").cast("decimal(20,6)") / F.when(F.col("vuelos_totales") != 0, F.col("vuelos_totales")) * 100).alias("otp_pct"),
        mean("delay", "n_delay", 0, 2).alias("delay_promedio_min"), _r("revenue").alias("revenue_total_usd"), _r("co2").alias("co2_emitido_ton"))


@query
def mv_months_fuel(L: Layers) -> DataFrame:
    """Fleet fuel efficiency after one month of the fuel fact was loaded again."""
    m = fuel_measures(L)
    da = L.dim_aircraft.select("aeronave_id", F.col("tipo").alias("tipo_aeronave"), "fabricante")
    keys = ("tipo_aeronave", "fabricante", "anio", "mes")
    return m.merge(_refreshed(L, "fact_fuel", m, F.col("aeronave_id") % 2 == 0).join(da, "aeronave_id"), *keys).select(
        *keys, "total_operaciones", _r("kg").alias("combustible_total_kg"), mean("eff", "n_eff", 4, 4).alias("eficiencia_promedio_kg_km"),
        mean("co2", "n_co2", 4, 4).alias("co2_promedio_pax_km"), mean("saf", "n_saf", 2, 4).alias("promedio_saf_pct"),
        _r("usd").alias("costo_total_combustible_usd"))


@query
def mv_months_cargo(L: Layers) -> DataFrame:
    """Cargo demand by route after one month of the cargo fact was loaded again."""
    m = cargo_measures(L)
    r = L.dim_route.select("ruta_id", "origen_icao", "destino_icao")
    keys = ("origen_icao", "destino_icao", "anio", "mes")
    return m.merge(_refreshed(L, "fact_cargo", m, F.col("ruta_id") % 2 == 0).join(r, "ruta_id"), *keys).select(
        *keys, "total_envios", _r("kg").alias("peso_total_kg"), _r("m3").alias("volumen_total_m3"), _r("usd").alias("revenue_total_usd"),
        mean("yield", "n_yield", 4, 4).alias("promedio_yield"), "carga_perecible", "carga_peligrosa", "retenciones_aduana")
