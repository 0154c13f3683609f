"""Geospatial and KPI queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.functions import kpi
from contrail.functions.codes import FT_TO_M, M_PER_NM
from contrail.functions.geo import valid_coordinates, with_line_distance, with_spheroid_distance
from contrail.operators.geojoin import nearest_join, within_join
from contrail.plans.context import Layers
from contrail.plans.queries import _dbl, query

AIRWAY_HALF_WIDTH_M = 9260.0   # 5 NM either side of the centreline


def _km_nm(d):
    return F.round(d / 1000, 2).alias("distancia_km"), F.round(d / M_PER_NM, 2).alias("distancia_nm")


@query
def airport_distance(L: Layers) -> DataFrame:
    """U1 over every flown (origin, destination) pair: self-join of airports."""
    pairs = L.fx.flights.select("origen_id", "destino_id").distinct()
    ap = L.fx.airports
    o = ap.select(F.col("aeropuerto_id").alias("origen_id"), F.col("latitude_deg").alias("la1"),
                  F.col("longitude_deg").alias("lo1"))
    d = ap.select(F.col("aeropuerto_id").alias("destino_id"), F.col("latitude_deg").alias("la2"),
                  F.col("longitude_deg").alias("lo2"))
    j = with_spheroid_distance(pairs.join(o, "origen_id").join(d, "destino_id"), "_m", "la1", "lo1", "la2", "lo2")
    return j.select(F.col("origen_id").alias("aeropuerto_origen"), F.col("destino_id").alias("aeropuerto_destino"), *_km_nm(F.col("_m")))


@query
def nearest_airport(L: Layers) -> DataFrame:
    """U2 for every position: descent of the pyramid of airport cells, exact against brute force."""
    pts = L.fx.positions.select("posicion_id", "latitud", "longitud")
    sites = L.fx.airports.select("aeropuerto_id", "latitude_deg", "longitude_deg", "nombre", "iata", "icao")
    nn = nearest_join(pts, "posicion_id", "latitud", "longitud", sites, "aeropuerto_id",
                      "latitude_deg", "longitude_deg", site_cols=["nombre", "iata", "icao"])
    return nn.select("posicion_id", "aeropuerto_id", "nombre", "iata", "icao",
                     F.round(F.col("dist_m") / 1000, 2).alias("distancia_km"),
                     F.round(F.col("dist_m") / M_PER_NM, 2).alias("distancia_nm"))


@query
def validate_coordinates(L: Layers) -> DataFrame:
    """U3 on navaid coordinates as stored and as mis-scaled (lat x 1.2, lon x 1.8)."""
    n = L.fx.navaids.select("id", F.col("latitude_deg").cast("double").alias("lat"),
                            F.col("longitude_deg").cast("double").alias("lon"))
    return n.select("id", "lat", "lon", valid_coordinates("lat", "lon").alias("valida"),
                    valid_coordinates(F.col("lat") * 1.2, F.col("lon") * 1.8).alias("valida_escalada"))


@query
def route_deviation(L: Layers) -> DataFrame:
    """Equi-join position -> its airway, geodesic distance to the airway in NM."""
    p = L.fx.positions.select("posicion_id", "aerovia_id", "latitud", "longitud")
    w = L.fx.airways.select("aerovia_id", "lat1", "lon1", "lat2", "lon2")
    j = with_line_distance(p.join(w, "aerovia_id"), "_xt", "latitud", "longitud", "lat1", "lon1", "lat2", "lon2")
    return j.select("posicion_id", "aerovia_id", F.round(F.col("_xt") / M_PER_NM, 2).alias("desviacion_nm"))


def _notam_zones(L: Layers) -> DataFrame:
    return L.fx.notams.join(L.fx.airports.select("aeropuerto_id", "latitude_deg", "longitude_deg"), "aeropuerto_id") \
        .select("notam_id", "ident", "radio_nm", "latitude_deg", "longitude_deg", "valido_desde", "valido_hasta",
                (F.col("radio_nm") * M_PER_NM).alias("radio_m"))


@query
def geo_within_join(L: Layers) -> DataFrame:
    """Positions inside a NOTAM circle, via geocell equi-join on a grid per class of radius."""
    p = L.fx.positions.select("posicion_id", "latitud", "longitud")
    j = within_join(p, "latitud", "longitud", _notam_zones(L), "latitude_deg", "longitude_deg", "radio_m")
    return j.select("notam_id", "ident", "posicion_id", F.lit(True).alias("dentro_zona"),
                    F.round(F.col("dist_m") / M_PER_NM, 2).alias("distancia_nm"), "radio_nm")


@query
def notam_entries(L: Layers) -> DataFrame:
    """U5 with B15: positions inside a NOTAM circle while that NOTAM is valid."""
    p = L.fx.positions.select("posicion_id", "vuelo_id", "timestamp_utc", "latitud", "longitud")
    j = within_join(p, "latitud", "longitud", _notam_zones(L), "latitude_deg", "longitude_deg", "radio_m",
                    "timestamp_utc", "valido_desde", "valido_hasta")
    return j.select("notam_id", "ident", "posicion_id", "vuelo_id", "timestamp_utc",
                    F.round(F.col("dist_m") / M_PER_NM, 2).alias("distancia_nm"), "radio_nm")


@query
def fuel_efficiency_per_flight(L: Layers) -> DataFrame:
    """U6 for every flight with fuel: 4-way join + spheroid distance + zero-safe division."""
    f = L.fx.flights.select("vuelo_id", "origen_id", "destino_id")
    c = L.fuel_landed.select("vuelo_id", "litros", "masa_kg")
    ap = L.fx.airports
    o = ap.select(F.col("aeropuerto_id").alias("origen_id"), F.col("latitude_deg").alias("la1"),
                  F.col("longitude_deg").alias("lo1"))
    d = ap.select(F.col("aeropuerto_id").alias("destino_id"), F.col("latitude_deg").alias("la2"),
                  F.col("longitude_deg").alias("lo2"))
    j = with_spheroid_distance(f.join(c, "vuelo_id").join(o, "origen_id").join(d, "destino_id"), "_m", "la1", "lo1", "la2", "lo2")
    km = F.col("_m") / 1000
    return _dbl(j.select("vuelo_id", F.col("litros").alias("litros_combustible"),
                         F.col("masa_kg").alias("masa_combustible_kg"), F.round(km, 2).alias("distancia_km"),
                         F.round(F.col("masa_kg").cast("double") / F.when(km != 0, km), 4).alias("eficiencia_kg_km")))


@query
def in_airway_3d(L: Layers) -> DataFrame:
    """Horizontal distance <= 9,260 m and altitude within the airway's flight levels."""
    p = L.fx.airway_points
    w = L.fx.airways.select("aerovia_id", "codigo", "lat1", "lon1", "lat2", "lon2", "nivel_min", "nivel_max")
    j = with_line_distance(p.join(w, "aerovia_id"), "_xt", "latitud", "longitud", "lat1", "lon1", "lat2", "lon2")
    inside = (F.col("_xt") <= AIRWAY_HALF_WIDTH_M) & F.col("altitud_pies").between(
        F.col("nivel_min") * 100, F.col("nivel_max") * 100)
    return j.select("punto_id", "aerovia_id", F.col("codigo").alias("designador"), inside.alias("dentro_aerovia"),
                    F.round(F.col("_xt") / M_PER_NM, 2).alias("distancia_nm"), "nivel_min", "nivel_max",
                    (F.col("altitud_pies") * F.lit(FT_TO_M).cast("decimal(5,4)")).cast("double").alias("altitud_m"))


@query
def kpi_functions(L: Layers) -> DataFrame:
    """U8-U12 per flight, through the registered SQL functions (invalid rows -> quarantined)."""
    kpi.register_sql_functions(L.spark)
    hv = L.fact_flight.select("vuelo_id", "pax_transportados", "asientos_ofrecidos", "distance_flown_km",
                              "passenger_revenue_usd")
    kg = L.cargo.groupBy("vuelo_id").agg(F.sum("peso_kg").alias("cargo_kg"))
    # the functions raise on a distance that is not positive: such rows are returned as quarantined
    j = hv.join(kg, "vuelo_id", "left")
    good = F.coalesce(F.col("distance_flown_km") > 0, F.lit(False))
    bad = j.where(~good).selectExpr("vuelo_id", *[f"cast(null as double) as {c}" for c in ("rpk", "ask", "load_factor_pct", "yield_usd_rpk", "ctk")],
                                    "true as en_cuarentena")
    out = j.where(good).selectExpr(
        "vuelo_id",
        "fn_calcular_rpk(pax_transportados, distance_flown_km) as rpk",
        "fn_calcular_ask(asientos_ofrecidos, distance_flown_km) as ask",
        "fn_calcular_load_factor(pax_transportados, asientos_ofrecidos) as load_factor_pct",
        "fn_calcular_yield(passenger_revenue_usd, fn_calcular_rpk(pax_transportados, distance_flown_km)) as yield_usd_rpk",
        "fn_calcular_ctk(coalesce(cargo_kg, 0), distance_flown_km) as ctk", "false as en_cuarentena")
    return _dbl(out).unionByName(bad)
