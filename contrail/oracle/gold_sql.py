"""DuckDB CTEs for the silver and gold objects the oracle queries read.

Independent SQL text for each Spark builder in ``contrail.plans``; the
fixture CTEs come from ``contrail.oracle.ctes``.
"""

from __future__ import annotations

from contrail.functions import codes
from contrail.oracle.ctes import _def
from contrail.oracle.det_sql import PICK, U

R2 = repr(2 * codes.EARTH_RADIUS_SPHERE_M)


def HAV(lat1, lon1, lat2, lon2, two_r=R2):
    p1, p2 = f"radians(cast({lat1} as double))", f"radians(cast({lat2} as double))"
    l1, l2 = f"radians(cast({lon1} as double))", f"radians(cast({lon2} as double))"
    h = (f"(pow(sin(({p2} - {p1}) / 2), 2) + cos({p1}) * cos({p2}) * pow(sin(({l2} - {l1}) / 2), 2))")
    return f"({two_r} * asin(sqrt(least(1.0, {h}))))"


def JSUM(j):
    return (f"list_sum(list_transform(json_keys({j}), lambda k: cast(json_extract_string({j}, k) as bigint)))")


def MAP_CASE(expr, pairs, default=None):
    whens = " ".join(f"when {_q(a)} then {_q(b)}" for a, b in pairs)
    els = f" else {_q(default)}" if default is not None else ""
    return f"(case {expr} {whens}{els} end)"


def _q(v):
    if v is None:
        return "null"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


HOL_IN = ", ".join(_q(h[0]) for h in codes.HOLIDAYS)

_def("g_dim_calendar", f"""
select cast(strftime(fecha, '%Y%m%d') as integer) as tiempo_id, fecha,
  year(fecha) as anio, quarter(fecha) as trimestre, month(fecha) as mes, day(fecha) as dia,
  isodow(fecha) as dia_semana, strftime(fecha, '%A') as nombre_dia,
  isodow(fecha) in (6, 7) as es_fin_semana,
  strftime(fecha, '%m-%d') in ({HOL_IN}) as es_festivo,
  {MAP_CASE("strftime(fecha, '%m-%d')", codes.HOLIDAYS)} as festivo_nombre,
  weekofyear(fecha) as semana_anio,
  case when month(fecha) in (6, 7, 8, 12) then 'ALTA' when month(fecha) in (3, 4, 5, 9, 10, 11) then 'MEDIA' else 'BAJA' end as temporada
from (select cast(unnest(generate_series(min(cast(ts as date)), max(cast(ts as date)), interval 1 day)) as date) as fecha
      from (select salida_programada as ts from f_flights union all select ts from events))""", ["f_flights"])

_def("g_dim_airport", f"""
select aeropuerto_id, icao, iata, nombre, ciudad, pais, region, zona_horaria, categoria, latitud, longitud from (
  select *, row_number() over (partition by icao order by (iata is null), volumen desc, aeropuerto_id) as rn from (
    select a.aeropuerto_id,
      left(coalesce(nullif(trim(a.icao), ''), nullif(trim(a.ident), '')), 4) as icao,
      nullif(trim(left(a.iata, 3)), '') as iata,
      a.nombre, a.municipality as ciudad, a.iso_country as pais,
      {MAP_CASE('a.continent', codes.CONTINENT_REGION, 'NORTEAMERICA')} as region,
      {MAP_CASE('a.iso_country', codes.COUNTRY_TZ, 'UTC')} as zona_horaria,
      case when c.cnt >= 100 then 'HUB' when c.cnt >= 20 then 'FOCUS_CITY' else 'SPOKE' end as categoria,
      a.latitude_deg as latitud, a.longitude_deg as longitud, c.cnt as volumen
    from f_airports a
    join (select origen_id as aeropuerto_id, count(*) as cnt from f_flights group by origen_id
          union all
          select destino_id, count(*) from f_flights group by destino_id) c on c.aeropuerto_id = a.aeropuerto_id
    where a.latitude_deg is not null and a.longitude_deg is not null and a.iso_country is not null
      and coalesce(nullif(trim(a.icao), ''), nullif(trim(a.ident), '')) is not null))
where rn = 1""", ["f_airports", "f_flights"])

_D = HAV("o.latitud", "o.longitud", "d.latitud", "d.longitud")
_def("g_dim_route", f"""
select cast(row_number() over (order by origen_icao, destino_icao) as integer) as ruta_id, * from (
  select o.icao as origen_icao, d.icao as destino_icao,
    round({_D} / 1852, 2) as distancia_nm,
    round({_D} / 1000, 2) as distancia_km,
    cast(floor({_D} / 1000 / 800 * 60) + 30 as integer) as duracion_estimada_min,
    case when {_D} / 1000 < 1500 then 'CORTO_HAUL' when {_D} / 1000 < 4000 then 'MEDIO_HAUL'
         when {_D} / 1000 < 8000 then 'LARGO_HAUL' else 'ULTRA_LARGO' end as tipo_ruta,
    case when o.pais = d.pais then 'DOMESTICO' when o.region = d.region then 'REGIONAL' else 'INTERCONTINENTAL' end as mercado
  from (select distinct origen_id, destino_id from f_flights where origen_id is not null and destino_id is not null) r
  join g_dim_airport o on o.aeropuerto_id = r.origen_id
  join g_dim_airport d on d.aeropuerto_id = r.destino_id)""", ["f_flights", "g_dim_airport"])

_def("g_dim_aircraft", f"""
select aeronave_id, left(matricula, 10) as matricula, left(tipo, 10) as tipo,
  case when upper(tipo) like 'AIRBUS%' or upper(tipo) like 'A3%' or upper(tipo) like 'A2%' then 'AIRBUS'
       when upper(tipo) like 'B%' or upper(tipo) like 'BOEING%' then 'BOEING'
       when upper(tipo) like 'E%' or upper(tipo) like 'EMB%' then 'EMBRAER' else 'BOEING' end as fabricante,
  cast(round(cast(date '2026-01-01' - fecha_alta as decimal(10,0)) / 365.25, 1) as double) as edad_anios,
  {JSUM('configuracion_asientos')} as configuracion_total_asientos,
  estado
from f_aircraft
where matricula is not null and configuracion_asientos is not null and fecha_alta is not null""", ["f_aircraft"])

# K7: fuel backfill + silver fuel
_k = "v.vuelo_id"
_lit = f"cast(3000 + {U(_k, 'bf_lit')} * 85000 as decimal(12,2))"
_den = f"cast(0.78 + {U(_k, 'bf_den')} * 0.05 as decimal(6,3))"
_pre = f"cast(0.75 + {U(_k, 'bf_pre')} * 0.20 as decimal(8,4))"
_def("g_fuel_backfill", f"""
select v.vuelo_id, v.origen_id as aeropuerto_id, {_lit} as litros, {_den} as densidad_kgl,
  cast({_lit} * {_den} as decimal(14,2)) as masa_kg, {_pre} as precio_litro_usd,
  cast({_lit} * {_pre} as decimal(14,2)) as costo_total_usd,
  v.salida_programada - interval 45 minute as timestamp_carga
from f_flights v
where v.salida_programada is not null
  and not exists (select 1 from s_fuel_landed cb where cb.vuelo_id = v.vuelo_id)""", ["f_flights", "s_fuel_landed"])

_def("g_fuel_all", """
select fuel_id, vuelo_id, aeropuerto_id, litros, densidad_kgl, cast(masa_kg as decimal(14,3)) as masa_kg,
  precio_litro_usd, costo_total_usd, timestamp_carga from s_fuel_landed
union all
select -vuelo_id - 1, vuelo_id, aeropuerto_id, litros, densidad_kgl, cast(masa_kg as decimal(14,3)),
  precio_litro_usd, costo_total_usd, timestamp_carga from g_fuel_backfill""", ["s_fuel_landed", "g_fuel_backfill"])

_def("g_route_lookup", """
select v.*, dr.ruta_id, dr.distancia_nm, dr.distancia_km, dr.tipo_ruta, dr.mercado, dr.origen_icao, dr.destino_icao
from f_flights v
join g_dim_airport ao on ao.aeropuerto_id = v.origen_id
join g_dim_airport ad on ad.aeropuerto_id = v.destino_id
join g_dim_route dr on dr.origen_icao = ao.icao and dr.destino_icao = ad.icao""",
     ["f_flights", "g_dim_airport", "g_dim_route"])

_k = "v.vuelo_id"
_delay = "coalesce(epoch_us(v.salida_real) - epoch_us(v.salida_programada), 0) / 6e7"
_block = "(epoch_us(v.llegada_programada) - epoch_us(v.salida_programada)) / 6e7"
_def("g_fact_flight_raw", f"""
select v.vuelo_id, cast(strftime(v.salida_programada, '%Y%m%d') as integer) as tiempo_id,
  v.aerolinea_id, v.ruta_id, v.aeronave_id, 1 as vuelos_totales,
  coalesce({JSUM('a.configuracion_asientos')}, 180) as asientos_ofrecidos,
  cast(coalesce(pv.sold, 0) as bigint) as asientos_vendidos,
  cast(coalesce(pv.boarded, 0) as bigint) as pax_transportados,
  cast(coalesce(pv.sold - pv.boarded, 0) as bigint) as pax_no_show,
  cast(coalesce(cg.rev, 0) as decimal(18,2)) as cargo_revenue_usd,
  cast(coalesce(pv.rev, 0) as decimal(18,2)) as passenger_revenue_usd,
  cast(coalesce(cb.cost, 0) as decimal(18,2)) as fuel_cost_usd,
  cast(cast(coalesce(cb.cost, 0) as decimal(18,2)) + cast(5000 + {U(_k, 'opc')} * 15000 as decimal(10,2)) as decimal(18,2)) as operating_cost_usd,
  cast(round({_block}) as integer) as block_time_min,
  cast(round({_block}) as integer) - 30 as airborne_time_min,
  30 as taxi_time_min,
  greatest(cast(round({_delay}) as integer), 0) as delay_min,
  case when v.motivo_desviacion is not null then
         case upper(v.motivo_desviacion) when 'WEATHER' then 'WEATHER' when 'TECHNICAL' then 'TECHNICAL' else 'GROUND' end
       when {_delay} > 15 then {PICK(['ATC', 'WEATHER', 'TECHNICAL', 'CREW', 'GROUND', 'PASSENGER'], _k, 'dcode')}
  end as delay_code,
  cast(coalesce(cb.kg, 0) as decimal(18,3)) as fuel_consumed_kg,
  v.tipo_ruta, v.distancia_nm as distance_flown_nm, v.distancia_km as distance_flown_km,
  cast(case v.tipo_ruta when 'CORTO_HAUL' then 28000 + floor({U(_k, 'alt')} * 5000)
                        when 'MEDIO_HAUL' then 33000 + floor({U(_k, 'alt')} * 5000)
                        when 'LARGO_HAUL' then 37000 + floor({U(_k, 'alt')} * 4000)
                        else 39000 + floor({U(_k, 'alt')} * 3000) end as integer) as altitude_max_ft,
  cast(420 + {U(_k, 'spd')} * 60 as decimal(8,2)) as speed_avg_kts,
  cast(coalesce(pv.rev, 0) + coalesce(cg.rev, 0) as decimal(18,2)) as total_revenue_usd,
  cast(case when cb.kg is null then 0 else round(coalesce(cb.kg, 0) * 3.16 / 1000, 2) end as decimal(18,2)) as co2_emitted_ton,
  v.estado, v.salida_programada
from g_route_lookup v
join f_aircraft a on a.aeronave_id = v.aeronave_id
join g_dim_aircraft dan on dan.aeronave_id = v.aeronave_id
join g_dim_calendar dt on dt.tiempo_id = cast(strftime(v.salida_programada, '%Y%m%d') as integer)
left join (select vuelo_id, count(*) as sold, sum(case when estado = 'BOARDED' then 1 else 0 end) as boarded,
                  sum(tarifa_usd) as rev from f_bookings group by vuelo_id) pv on pv.vuelo_id = v.vuelo_id
left join (select vuelo_id, sum(peso_kg * 2.5) as rev from s_cargo group by vuelo_id) cg on cg.vuelo_id = v.vuelo_id
left join (select vuelo_id, sum(masa_kg) as kg, sum(costo_total_usd) as cost from g_fuel_all group by vuelo_id) cb
  on cb.vuelo_id = v.vuelo_id
where v.salida_programada is not null and v.llegada_programada is not null""",
     ["g_route_lookup", "f_aircraft", "g_dim_aircraft", "g_dim_calendar", "f_bookings", "s_cargo", "g_fuel_all"])

_k = "vuelo_id"
_c = "pax_transportados < 3"
_seats = "asientos_ofrecidos"
_fare = (f"(case when distance_flown_km < 1500 then 200 + {U(_k, 'en_f')} * 250 "
         f"when distance_flown_km < 4000 then 400 + {U(_k, 'en_f')} * 400 "
         f"when distance_flown_km < 8000 then 700 + {U(_k, 'en_f')} * 600 "
         f"else 1200 + {U(_k, 'en_f')} * 800 end)")
_def("g_fact_flight", f"""
select * replace (
  case when {_c} then cast(floor({_seats} * (0.75 + {U(_k, 'en_s')} * 0.20)) as bigint) else asientos_vendidos end as asientos_vendidos,
  case when {_c} then cast(floor({_seats} * (0.75 + {U(_k, 'en_b1')} * 0.20) * (0.95 + {U(_k, 'en_b2')} * 0.04)) as bigint) else pax_transportados end as pax_transportados,
  case when {_c} then cast(floor({_seats} * (0.75 + {U(_k, 'en_n1')} * 0.20) * (0.01 + {U(_k, 'en_n2')} * 0.04)) as bigint) else pax_no_show end as pax_no_show,
  case when {_c} then cast(floor({_seats} * (0.75 + {U(_k, 'en_r')} * 0.20)) * {_fare} as decimal(18,2)) else passenger_revenue_usd end as passenger_revenue_usd,
  cast(case when {_c} then cast(floor({_seats} * (0.75 + {U(_k, 'en_r')} * 0.20)) * {_fare} as decimal(18,2)) else passenger_revenue_usd end
       + cargo_revenue_usd as decimal(18,2)) as total_revenue_usd)
from g_fact_flight_raw""", ["g_fact_flight_raw"])
