"""DuckDB oracle for geospatial and KPI queries.

Spatial joins are checked against brute force (every point against every
zone / site), so the geocell pruning on the Spark side is verified, not
mirrored.
"""

from __future__ import annotations

from contrail.oracle.det_sql import DIV_DEC

#: WGS84, and the sphere that the reference's sphere distance uses.
_A, _F = 6378137.0, 1 / 298.257223563
_B = _A * (1 - _F)


def _rad(x):
    return f"radians(cast({x} as double))"


def _over(src, **columns):
    return f"select *, {', '.join(f'{e} as {n}' for n, e in columns.items())} from ({src})"


def GEODESIC(src, lat1, lon1, lat2, lon2, out):
    """``src`` with Vincenty's distance: three times two steps and Aitken's extrapolation, and a last step."""
    tau = "(2 * pi())"
    src = _over(src, b1=f"atan((1 - {_F!r}) * tan({_rad(lat1)}))", b2=f"atan((1 - {_F!r}) * tan({_rad(lat2)}))", l0=f"{_rad(lon2)} - {_rad(lon1)}",
                f1=_rad(lat1), f2=_rad(lat2))
    src = _over(src, l=f"l0 - {tau} * round_even(l0 / {tau}, 0)", s1="sin(b1)", c1="cos(b1)", s2="sin(b2)", c2="cos(b2)")
    src = _over(src, x="l")

    def arc(src, lam):
        src = _over(src, sg=f"sqrt((c2 * sin({lam})) ** 2 + (c1 * s2 - s1 * c2 * cos({lam})) ** 2)", cg=f"s1 * s2 + c1 * c2 * cos({lam})")
        src = _over(src, sq=f"case when sg = 0 then 0.0 else c1 * c2 * sin({lam}) / sg end")
        src = _over(src, cq="1 - sq * sq", g="atan2(sg, cg)")
        return _over(src, m="case when cq < 1e-15 then 0.0 else cg - 2 * s1 * s2 / cq end", k=f"{_F!r} / 16 * cq * (4 + {_F!r} * (4 - 3 * cq))")

    def step(src, lam, to):
        src = arc(src, lam)
        new = f"l + (1 - k) * {_F!r} * sq * (g + k * sg * (m + k * cg * (2 * m * m - 1)))"
        return f"select * exclude (sg, cg, sq, cq, g, m, k), {new} as {to} from ({src})"

    for _ in range(3):
        src = step(step(src, "x", "y"), "y", "z")
        src = f"select * exclude (x, y, z), case when abs(z - 2 * y + x) < 1e-15 then z else x - (y - x) ** 2 / (z - 2 * y + x) end as x from ({src})"
    src = arc(step(src, "x", "w"), "w")
    src = _over(src, uu=f"cq * {(_A**2 - _B**2) / _B**2!r}")
    src = _over(src, ka="1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu)))", kb="uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu)))")
    long = f"{_B!r} * ka * (g - kb * sg * (m + kb / 4 * (cg * (-1 + 2 * m * m) - kb / 6 * m * (-3 + 4 * sg * sg) * (-3 + 4 * m * m))))"
    n = _F / (2 - _F)

    def arc_to(f):
        return (f"{_A / (1 + n)!r} * ({1 + n**2 / 4 + n**4 / 64!r} * {f} - {1.5 * (n - n**3 / 8)!r} * sin(2 * {f}) + {15 / 16 * (n**2 - n**4 / 4)!r} * sin(4 * {f})"
                f" - {35 / 48 * n**3!r} * sin(6 * {f}))")

    pole = f"{_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)!r} * pi() - abs({arc_to('f1')} + {arc_to('f2')})"
    temp = "b1, b2, l0, f1, f2, l, s1, c1, s2, c2, x, w, sg, cg, sq, cq, g, m, k, uu, ka, kb"
    return f"select * exclude ({temp}), case when coalesce(abs(w - x) <= 1e-9, false) then {long} when l0 is null or f1 is null or f2 is null then null else {pole} end as {out} from ({src})"


def TO_LINE(src, plat, plon, lat1, lon1, lat2, lon2, out):
    """``src`` with the geodesic from P to the point of the great-circle segment A-B that is next to it on the sphere."""
    src = _over(src, ya=_rad(lat1), xa=_rad(lon1), yb=_rad(lat2), xb=_rad(lon2), yp=_rad(plat), xp=_rad(plon))

    def angle(y1, x1, y2, x2):
        return f"2 * asin(sqrt(least(1.0, sin(({y2} - {y1}) / 2) ** 2 + cos({y1}) * cos({y2}) * sin(({x2} - {x1}) / 2) ** 2)))"

    def heading(y, x):
        return f"atan2(sin({x} - xa) * cos({y}), cos(ya) * sin({y}) - sin(ya) * cos({y}) * cos({x} - xa))"

    src = _over(src, ap=angle("ya", "xa", "yp", "xp"), ab=angle("ya", "xa", "yb", "xb"), bp=angle("yb", "xb", "yp", "xp"), hp=heading("yp", "xp"), hb=heading("yb", "xb"))
    src = _over(src, way="atan2(sin(ap) * cos(hp - hb), cos(ap))")
    src = _over(src, yf="asin(sin(ya) * cos(way) + cos(ya) * sin(way) * cos(hb))", inside="way >= 0 and way <= ab and ab > 0")
    src = _over(src, foot_y="degrees(case when inside then yf when ap <= bp then ya else yb end)",
                foot_x="degrees(case when inside then xa + atan2(sin(hb) * sin(way) * cos(ya), cos(way) - sin(ya) * sin(yf)) when ap <= bp then xa else xb end)")
    src = f"select * exclude (ya, xa, yb, xb, yp, xp, ap, ab, bp, hp, hb, way, yf, inside) from ({src})"
    return f"select * exclude (foot_y, foot_x) from ({GEODESIC(src, plat, plon, 'foot_y', 'foot_x', out)})"


def register(oracle):
    way = GEODESIC("""select origen_id, destino_id, o.latitude_deg as oy, o.longitude_deg as ox, t.latitude_deg as ty, t.longitude_deg as tx
from (select distinct origen_id, destino_id from f_flights) r
join f_airports o on o.aeropuerto_id = r.origen_id join f_airports t on t.aeropuerto_id = r.destino_id""", "oy", "ox", "ty", "tx", "d")
    oracle("airport_distance", f"""
select origen_id as aeropuerto_origen, destino_id as aeropuerto_destino, round(d / 1000, 2) as distancia_km, round(d / 1852.0, 2) as distancia_nm
from ({way})""", ["f_flights", "f_airports"])
    near = GEODESIC("""select posicion_id, latitud, longitud, aeropuerto_id, nombre, iata, icao, latitude_deg, longitude_deg
from f_positions, f_airports where latitud is not null and longitud is not null and latitude_deg is not null and longitude_deg is not null""",
                    "latitud", "longitud", "latitude_deg", "longitude_deg", "d")
    oracle("nearest_airport", f"""
select posicion_id, b.sid as aeropuerto_id, b.nombre, b.iata, b.icao, round(b.d / 1000, 2) as distancia_km,
  round(b.d / 1852.0, 2) as distancia_nm
from (select posicion_id, min({{'d': d, 'sid': aeropuerto_id, 'nombre': nombre, 'iata': iata, 'icao': icao}}) as b
      from ({near}) group by posicion_id)""", ["f_positions", "f_airports"])
    oracle("validate_coordinates", """
select id, cast(latitude_deg as double) as lat, cast(longitude_deg as double) as lon,
  cast(latitude_deg as double) between -90 and 90 and cast(longitude_deg as double) between -180 and 180 as valida,
  cast(latitude_deg as double) * 1.2 between -90 and 90 and cast(longitude_deg as double) * 1.8 between -180 and 180 as valida_escalada
from f_navaids""", ["f_navaids"])
    off = TO_LINE("select p.posicion_id, p.aerovia_id, p.latitud, p.longitud, w.lat1, w.lon1, w.lat2, w.lon2 from f_positions p join f_airways w on w.aerovia_id = p.aerovia_id",
                  "latitud", "longitud", "lat1", "lon1", "lat2", "lon2", "xt")
    oracle("route_deviation", f"select posicion_id, aerovia_id, round(xt / 1852.0, 2) as desviacion_nm from ({off})", ["f_positions", "f_airways"])
    inside = GEODESIC("""select n.notam_id, n.ident, n.radio_nm, n.valido_desde, n.valido_hasta, a.latitude_deg, a.longitude_deg, p.posicion_id, p.vuelo_id, p.timestamp_utc, p.latitud, p.longitud
from f_notams n join f_airports a on a.aeropuerto_id = n.aeropuerto_id, f_positions p
-- a degree of latitude has at least 110.5 km
where abs(cast(p.latitud as double) - cast(a.latitude_deg as double)) <= n.radio_nm * 1852.0 / 110500 + 0.01""", "latitud", "longitud", "latitude_deg", "longitude_deg", "dist")
    oracle("geo_within_join", f"""
select notam_id, ident, posicion_id, true as dentro_zona, round(dist / 1852.0, 2) as distancia_nm, radio_nm
from ({inside}) where dist <= radio_nm * 1852.0""", ["f_notams", "f_airports", "f_positions"])
    oracle("notam_entries", f"""
select notam_id, ident, posicion_id, vuelo_id, timestamp_utc, round(dist / 1852.0, 2) as distancia_nm, radio_nm
from ({inside}) where dist <= radio_nm * 1852.0 and timestamp_utc between valido_desde and valido_hasta""", ["f_notams", "f_airports", "f_positions"])
    burn = GEODESIC("""select v.vuelo_id, c.litros, c.masa_kg, o.latitude_deg as oy, o.longitude_deg as ox, t.latitude_deg as ty, t.longitude_deg as tx
from f_flights v join s_fuel_landed c on c.vuelo_id = v.vuelo_id
join f_airports o on o.aeropuerto_id = v.origen_id join f_airports t on t.aeropuerto_id = v.destino_id""", "oy", "ox", "ty", "tx", "d")
    oracle("fuel_efficiency_per_flight", f"""
select vuelo_id, cast(litros as double) as litros_combustible, cast(masa_kg as double) as masa_combustible_kg, round(d / 1000, 2) as distancia_km,
  round(cast(masa_kg as double) / (case when d / 1000 <> 0 then d / 1000 end), 4) as eficiencia_kg_km
from ({burn})""", ["f_flights", "s_fuel_landed", "f_airports"])
    lane = TO_LINE("""select p.punto_id, p.aerovia_id, w.codigo as designador, p.altitud_pies, w.nivel_min, w.nivel_max, p.latitud, p.longitud, w.lat1, w.lon1, w.lat2, w.lon2
from f_airway_points p join f_airways w on w.aerovia_id = p.aerovia_id""", "latitud", "longitud", "lat1", "lon1", "lat2", "lon2", "xt")
    oracle("in_airway_3d", f"""
select punto_id, aerovia_id, designador, xt <= 9260.0 and altitud_pies between nivel_min * 100 and nivel_max * 100 as dentro_aerovia,
  round(xt / 1852.0, 2) as distancia_nm, nivel_min, nivel_max, cast(altitud_pies * 0.3048 as double) as altitud_m
from ({lane})""", ["f_airway_points", "f_airways"])
    oracle("kpi_functions", f"""
select vuelo_id,
  cast(round(cast(pax_transportados as decimal(18,0)) * km, 2) as double) as rpk,
  cast(round(cast(asientos_ofrecidos as decimal(18,0)) * km, 2) as double) as ask,
  case when asientos_ofrecidos = 0 then 0.0
       else least({DIV_DEC('pax_transportados * 100', 'asientos_ofrecidos', 0, 0, 16, 2)}, 100.0) end as load_factor_pct,
  {DIV_DEC('cast(passenger_revenue_usd as decimal(18,2))', 'round(cast(pax_transportados as decimal(18,0)) * km, 2)', 2, 2, 20, 4)} as yield_usd_rpk,
  cast(round(cast(coalesce(cargo_kg, 0) as decimal(18,2)) * 0.001 * km, 2) as double) as ctk, false as en_cuarentena
from (select hv.*, cast(hv.distance_flown_km as decimal(12,2)) as km, cg.cargo_kg
      from g_fact_flight hv left join (select vuelo_id, sum(peso_kg) as cargo_kg from s_cargo group by vuelo_id) cg
        on cg.vuelo_id = hv.vuelo_id
      where hv.distance_flown_km > 0)
union all
select vuelo_id, null, null, null, null, null, true from g_fact_flight where not coalesce(distance_flown_km > 0, false)""", ["g_fact_flight", "s_cargo"])
