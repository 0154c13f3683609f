"""DuckDB oracle for the silver pipelines (J*)."""

from __future__ import annotations

from contrail.functions import codes
from contrail.oracle.ctes import _def
from contrail.oracle.det_sql import PICK, U
from contrail.oracle.gold_sql import MAP_CASE, _q
from contrail.plans.silver import (ACTION_COST, BAG_STATES, CREW_ROLES, INLINE_AIRCRAFT, WAYPOINT_TYPES,
                                   WORKSHOPS)

_NAMES = [(a, n) for a, n, _ in codes.AIRLINES]
_CTRY = [(a, c) for a, _, c in codes.AIRLINES]


def _values(rows):
    out = []
    for r in rows:
        vals = []
        for v in r:
            if isinstance(v, list):
                vals.append("[" + ", ".join(_q(x) for x in v) + "]")
            else:
                vals.append(_q(v))
        out.append("(" + ", ".join(vals) + ")")
    return ", ".join(out)


_def("s_airlines", f"""
select codigo_iata, codigo_icao,
  {MAP_CASE('codigo_icao', _NAMES, codes.UNKNOWN_AIRLINE[0])} as nombre,
  {MAP_CASE('codigo_icao', _CTRY, codes.UNKNOWN_AIRLINE[1])} as pais_codigo
from (select distinct left(upper(trim(numero_vuelo)), 2) as codigo_iata, left(upper(trim(numero_vuelo)), 3) as codigo_icao
      from f_flights where numero_vuelo is not null and trim(numero_vuelo) <> '')""", ["f_flights"])

_def("s_airline_dim", "select * from (values " + ", ".join(
    f"({i + 1}, {_q(a)}, {_q(a[:2])}, {_q(n)}, {_q(c)})" for i, (a, n, c) in enumerate(codes.AIRLINES))
     + ") t(aerolinea_id, codigo_icao, codigo_iata, nombre, pais_codigo)")

_def("s_clean_flights", """
select v.vuelo_id, v.numero_vuelo, coalesce(al.nombre, 'Unknown Airline') as aerolinea, o.ident as origen_ident, d.ident as destino_ident,
  v.salida_programada, v.llegada_programada, v.estado
from f_flights v
left join s_airline_dim al on al.codigo_icao = left(upper(trim(v.numero_vuelo)), 3)
join f_airports o on o.aeropuerto_id = v.origen_id
join f_airports d on d.aeropuerto_id = v.destino_id
where v.numero_vuelo is not null and trim(v.numero_vuelo) <> '' and v.origen_id is not null and v.destino_id is not null""",
     ["f_flights", "s_airline_dim", "f_airports"])

_def("s_passengers", """
select distinct 'DOC-' || cast(reserva_id as varchar) as documento,
  coalesce(json_extract_string(pasajero_json, '$.document_type'), 'PASSPORT') as tipo_doc,
  coalesce(json_extract_string(pasajero_json, '$.nationality'), 'CR') as nacionalidad,
  trim(coalesce(json_extract_string(pasajero_json, '$.first_name'), '') || ' ' || coalesce(json_extract_string(pasajero_json, '$.last_name'), '')) as nombre,
  case when cast(json_extract_string(pasajero_json, '$.frequent_flyer') as boolean) then 'GOLD' end as programa_fidelidad,
  case when clase in ('F', 'J') then 'FIRST' when clase in ('C', 'W') then 'BUSINESS' else 'ECONOMY' end as categoria
from f_reservations where pasajero_json is not null""", ["f_reservations"])

_def("s_bookings", """
select reserva_id, vuelo_id, pasajero_id, pnr, clase, asiento, tarifa_usd, estado from (
  select r.reserva_id, v.vuelo_id, p.pasajero_id, left(r.pnr, 10) as pnr, left(r.clase, 5) as clase,
    coalesce(left(b.asiento, 5), 'NA') as asiento, cast(r.tarifa_usd as double) as tarifa_usd,
    case when b.boarding_id is not null then 'BOARDED'
         when upper(r.estado) in ('CONFIRMED', 'CHECKED', 'NOSHOW') then upper(r.estado) else 'CONFIRMED' end as estado,
    row_number() over (partition by r.reserva_id order by p.pasajero_id, b.timestamp_utc desc nulls last,
                       v.vuelo_id, coalesce(b.boarding_id, -1)) as rn
  from f_reservations r
  join f_passengers p on p.nombre = json_extract_string(r.pasajero_json, '$.first_name') || ' ' || json_extract_string(r.pasajero_json, '$.last_name')
                     and p.nacionalidad = json_extract_string(r.pasajero_json, '$.nationality')
  join f_flights v on v.numero_vuelo = json_extract_string(r.vuelos_json, '$.flight_number')
  left join f_boarding b on b.pnr = r.pnr
  where r.pnr is not null and json_extract_string(r.vuelos_json, '$.flight_number') is not null)
where rn = 1""", ["f_reservations", "f_passengers", "f_flights", "f_boarding"])

_def("s_baggage", f"""
select tag_id, vuelo_id, estado, ubicacion_actual, timestamp_ultimo_evento from (
  select left(b.tag_id, 20) as tag_id, b.vuelo_id, {MAP_CASE('upper(b.evento)', BAG_STATES, 'CHECKED')} as estado,
    left(b.aeropuerto, 50) as ubicacion_actual, b.timestamp_utc as timestamp_ultimo_evento,
    row_number() over (partition by left(b.tag_id, 20) order by b.timestamp_utc desc, b.baggage_id) as rn
  from f_baggage b join f_flights v on v.vuelo_id = b.vuelo_id
  where b.tag_id is not null and b.timestamp_utc is not null)
where rn = 1""", ["f_baggage", "f_flights"])

_CT = ", ".join(_q(t) for t in codes.CARGO_TYPES)
_def("s_cargo", f"""
select awb, vuelo_id, shipper, consignee, tipo, peso_kg, volumen_m3, temperatura_req, tiene_declaracion, declaracion_aduanera from (
  select left(c.awb, 20) as awb, c.vuelo_id,
    left(json_extract_string(c.declaracion_json, '$.shipper'), 200) as shipper,
    left(json_extract_string(c.declaracion_json, '$.consignee'), 200) as consignee,
    case when upper(c.tipo_carga) in ({_CT}) then upper(c.tipo_carga) else 'GENERAL' end as tipo,
    cast(c.peso_kg as decimal(8,2)) as peso_kg, cast(c.volumen_m3 as decimal(6,2)) as volumen_m3,
    left(json_extract_string(c.declaracion_json, '$.temperature_required'), 10) as temperatura_req,
    c.declaracion_json is not null as tiene_declaracion, c.declaracion_json as declaracion_aduanera,
    row_number() over (partition by left(c.awb, 20) order by c.vuelo_id,
      json_extract_string(c.declaracion_json, '$.shipper') nulls first, json_extract_string(c.declaracion_json, '$.consignee') nulls first,
      case when upper(c.tipo_carga) in ({_CT}) then upper(c.tipo_carga) else 'GENERAL' end,
      cast(c.peso_kg as decimal(8,2)), cast(c.volumen_m3 as decimal(6,2)),
      left(json_extract_string(c.declaracion_json, '$.temperature_required'), 10) nulls first,
      c.declaracion_json is not null, c.declaracion_json nulls first) as rn
  from f_cargo c join f_flights v on v.vuelo_id = c.vuelo_id
  where c.awb is not null and c.peso_kg > 0 and c.volumen_m3 > 0)
where rn = 1""", ["f_cargo", "f_flights"])

_k = "awb"
_need = "(shipper is null or consignee is null or temperatura_req is null)"
_def("s_cargo_enriched", f"""
select * replace (
  case when {_need} then 'SHIPPER-' || lpad(cast(cast(floor({U(_k, 'ce_s')} * 1000) as integer) as varchar), 4, '0') else shipper end as shipper,
  case when {_need} then 'CONSIGNEE-' || lpad(cast(cast(floor({U(_k, 'ce_c')} * 1000) as integer) as varchar), 4, '0') else consignee end as consignee,
  case when {_need} then
    case tipo when 'PERECIBLE' then {PICK(['2-8C', '-18C', '-25C', '0-4C'], _k, 'ce_t')}
              when 'ANIMALES' then {PICK(['15-25C', '18-22C'], _k, 'ce_t')}
              when 'VALORADA' then 'AMBIENT'
              when 'PELIGROSA' then {PICK(['AMBIENT', '15-30C', 'COOL'], _k, 'ce_t')}
              else 'AMBIENT' end
  else temperatura_req end as temperatura_req)
from s_cargo""", ["s_cargo"])

_def("s_crew", "select * exclude (regla) from s_crew_judged where regla is null", ["s_crew_judged"])

# the reference caps duty at 12 hours on load, and its trigger looks at the loaded row
_def("s_crew_judged", """
select * exclude (rn), case when horas_vuelo_duty > 12 then 'M5_DUTY' when descanso_horas < descanso_minimo_requerido then 'M5_REST' end as regla from (
  select *, row_number() over (partition by roster_id order by vuelo_id, crew_id, rol, report_time, duty_start,
    duty_end, horas_vuelo_duty, descanso_horas, descanso_minimo_requerido, descanso_minimo_cumple) as rn
  from s_crew_rows)
where rn = 1""", ["s_crew_rows"])

_def("s_crew_rows", f"""
select c.roster_id, c.vuelo_id, c.crew_id, {MAP_CASE('upper(c.rol)', CREW_ROLES, 'FA')} as rol,
  c.report_time, c.report_time as duty_start,
  c.report_time + to_microseconds(cast(c.duty_hours * 3600000000 as bigint)) as duty_end,
  cast(least(c.duty_hours, 12) as decimal(4,2)) as horas_vuelo_duty,
  cast(c.descanso_horas as decimal(5,2)) as descanso_horas,
  cast(c.descanso_minimo as decimal(4,2)) as descanso_minimo_requerido,
  c.descanso_horas >= c.descanso_minimo as descanso_minimo_cumple
from f_crew c join f_flights v on v.vuelo_id = c.vuelo_id
where c.vuelo_id is not null and c.report_time is not null and c.duty_hours is not null and c.duty_hours > 0""",
     ["f_crew", "f_flights"])

_k = "aeronave_id"
_def("s_synth_fleet", f"""
select aeronave_id, 'TI-' || lpad(cast(aeronave_id + 1 as varchar), 4, '0') as matricula,
  {PICK(codes.AIRCRAFT_TYPES, _k, 'sf_tipo')} as tipo,
  case when {U(_k, 'sf_s1')} < 0.25 then {_q(codes.SEAT_MAPS[0])} when {U(_k, 'sf_s2')} < 0.50 then {_q(codes.SEAT_MAPS[1])}
       when {U(_k, 'sf_s3')} < 0.75 then {_q(codes.SEAT_MAPS[2])} else {_q(codes.SEAT_MAPS[3])} end as configuracion_asientos,
  cast(round(cast(500 + {U(_k, 'sf_h')} * 60000 as decimal(18,6)), 2) as double) as horas_vuelo_totales,
  case when {U(_k, 'sf_e')} < 0.90 then 'ACTIVO' else 'MANTENIMIENTO' end as estado,
  cast(date '2026-01-01' - cast(floor({U(_k, 'sf_d')} * 5000) as integer) as date) as fecha_entrada_servicio
from (select distinct o_custkey % 100 as aeronave_id from orders)""")

_def("s_inline_aircraft", "select * from (values " + ", ".join(
    f"({_q(m)}, {_q(t)}, {_q(c)})" for m, t, c in INLINE_AIRCRAFT) + ") t(matricula, tipo, configuracion_asientos)")

_def("s_workshops", f"""
select cast(row_number() over (order by w.nombre) as integer) as taller_id, w.nombre,
  coalesce(bi.aeropuerto_id, pk.aeropuerto_id) as aeropuerto_id, w.tipo, w.capacidad, w.certificaciones, true as activo,
  w.iata_code
from (values {_values(WORKSHOPS)}) w(nombre, iata_code, tipo, capacidad, certificaciones)
left join (select iata as iata_code, min(aeropuerto_id) as aeropuerto_id from f_airports where iata is not null group by iata) bi
  on bi.iata_code = w.iata_code
left join (select aeropuerto_id, row_number() over (order by aeropuerto_id) - 1 as ci from f_airports) pk
  on pk.ci = cast(floor({U('w.nombre', 'wk_ap')} * (select count(*) from f_airports)) as bigint)""", ["f_airports"])

_k = "(cast(a.aeronave_id as varchar) || '|' || cast(p.posicion as varchar))"
_def("s_engines", f"""
select a.aeronave_id * 2 + p.posicion - 1 as motor_id, a.aeronave_id, p.posicion,
  case when a.tipo like '%A320%' or a.tipo like '%A330%' then {PICK(['CFM56-5B', 'V2500', 'PW1100'], _k, 'eng_m')}
       when a.tipo like '%B737%' then 'CFM56-7B'
       when a.tipo like '%B787%' then {PICK(['TRENT-1000', 'GENX-1B'], _k, 'eng_m')}
       else 'CFM56-7B' end as modelo,
  'SN-' || a.matricula || '-' || cast(p.posicion as varchar) as serial_number,
  cast(round(cast(1000 + {U(_k, 'eng_h')} * 50000 as decimal(18,6)), 2) as double) as horas_acumuladas,
  cast(floor(500 + {U(_k, 'eng_c')} * 30000) as integer) as ciclos_acumulados
from f_aircraft a cross join (values (1), (2)) p(posicion)""", ["f_aircraft"])

_k = "m.evento_id"
_cost = "case upper(m.accion) " + " ".join(
    f"when {_q(n)} then {b} + {U(_k, 'mc')} * {s}" for n, b, s in ACTION_COST) + " else 500.0 end"
_def("s_maintenance", f"""
select m.evento_id, m.aeronave_id, fe.motor_id,
  {MAP_CASE('upper(m.accion)', codes.ACTION_CHECK, 'LINE')} as tipo_check,
  left(coalesce(m.componente, 'GENERAL'), 50) as componente,
  m.accion as descripcion,
  coalesce(w.taller_id, cast(floor({U(_k, 'mt')} * {len(WORKSHOPS)}) + 1 as integer)) as taller_id,
  coalesce(cast(nullif(regexp_replace(m.tecnico_id, '[^0-9]', '', 'g'), '') as integer),
           cast(floor(1 + {U(_k, 'mtec')} * 9999) as integer)) as tecnico_id,
  cast(m.horas_aeronave as decimal(10,2)) as horas_aeronave,
  m.timestamp_utc as fecha_inicio,
  m.timestamp_utc + to_hours(cast({MAP_CASE('upper(m.accion)', codes.ACTION_HOURS, codes.ACTION_HOURS_DEFAULT)} as integer)) as fecha_fin,
  round(cast({_cost} as decimal(18,6)), 2) as costo_usd,
  m.estado
from f_maintenance m
join f_aircraft a on a.aeronave_id = m.aeronave_id
left join (select aeronave_id, arg_min(motor_id, posicion) as motor_id from s_engines group by aeronave_id) fe
  on fe.aeronave_id = m.aeronave_id
left join s_workshops w on w.iata_code = m.taller_codigo
where m.aeronave_id is not null and m.timestamp_utc is not null and m.horas_aeronave is not null
  and m.horas_aeronave >= 0 and m.accion is not null""", ["f_maintenance", "f_aircraft", "s_engines", "s_workshops"])

_def("s_fuel", """
select f.fuel_id, f.vuelo_id, f.aeropuerto_id, cast(f.litros as decimal(10,2)) as litros,
  cast(f.densidad_kgl as decimal(5,3)) as densidad_kgl, cast(f.litros * f.densidad_kgl as decimal(10,2)) as masa_kg,
  cast(case when f.litros > 0 then round(f.costo_total_usd / f.litros, 4) else 0 end as decimal(10,4)) as precio_usd_litro,
  cast(f.costo_total_usd as decimal(12,2)) as costo_total_usd, f.timestamp_carga
from s_fuel_landed f join f_flights v on v.vuelo_id = f.vuelo_id join f_airports a on a.aeropuerto_id = f.aeropuerto_id
where f.litros > 0 and f.densidad_kgl > 0 and f.costo_total_usd >= 0 and f.timestamp_carga is not null""",
     ["s_fuel_landed", "f_flights", "f_airports"])

_alt = "coalesce(cast(p.altitud_pies as double), 0.0)"
_v = "cast(p.velocidad_nudos as double)"
PHASE = (f"case when {_alt} < 1000 and {_v} < 50 then 'TAXI' when {_alt} < 1500 and {_v} >= 50 then 'TAKEOFF' "
         f"when {_alt} between 1500 and 18000 and {_v} >= 200 then 'CLIMB' when {_alt} > 28000 then 'CRUISE' "
         f"when {_alt} between 10000 and 28000 then 'DESCENT' when {_alt} between 3000 and 10000 then 'APPROACH' "
         f"else 'LANDING' end")
_def("s_positions", f"""
select p.posicion_id, p.vuelo_id, p.timestamp_utc, cast(p.longitud as double) as lon, cast(p.latitud as double) as lat,
  cast(round(coalesce(p.altitud_pies * 0.3048, 0), 4) as double) as z_m,
  cast(cast(p.velocidad_nudos as decimal(6,2)) as double) as velocidad_nudos,
  cast(p.heading as double) as heading,
  {PHASE} as fase_vuelo,
  p.aerovia_id as aerovia_cercana_id,
  cast(p.desviacion_nm as double) as desviacion_nm
from f_positions p join f_flights v on v.vuelo_id = p.vuelo_id
where p.latitud is not null and p.longitud is not null and p.timestamp_utc is not null
  and p.velocidad_nudos is not null and p.heading is not null""", ["f_positions", "f_flights"])

_def("s_sensors", """
select * from f_sensors
where engine_id is not null and timestamp_utc is not null and n1_pct between 0 and 110 and n2_pct between 0 and 110
  and egt_c between -50 and 1200 and fuel_flow_kgh >= 0 and vibration >= 0""", ["f_sensors"])

_WT = ", ".join(_q(t) for t in WAYPOINT_TYPES)
_def("s_waypoints", f"""
select *, row_number() over (order by ident) as waypoint_id from (
  select * exclude (rn) from (
    select id as source_id, left(ident, 10) as ident, left(name, 100) as nombre, type as tipo,
      case when frequency_khz >= 0 then frequency_khz end as frecuencia_khz,
      latitude_deg as latitud_deg, longitude_deg as longitud_deg, elevation_ft,
      iso_country, iso_region as region_code,
      case when dme_frequency_khz >= 0 then dme_frequency_khz end as dme_frequency_khz,
      left(dme_channel, 10) as dme_channel, left(filename, 100) as fuente_archivo,
      case when longitude_deg is not null and latitude_deg is not null then cast(longitude_deg as double) end as pt_lon,
      case when longitude_deg is not null and latitude_deg is not null then cast(latitude_deg as double) end as pt_lat,
      case when longitude_deg is not null and latitude_deg is not null then cast(coalesce(elevation_ft, 0) as double) end as pt_z,
      row_number() over (partition by left(ident, 10) order by id) as rn
    from f_navaids where type in ({_WT}))
  where rn = 1)""", ["f_navaids"])

_def("s_airport_fk", """
select a.aeropuerto_id, a.ident, a.iso_country, a.iso_region,
  coalesce(a.country_id, c.country_id) as country_id, coalesce(a.region_id, r.region_id) as region_id,
  case when a.latitude_deg between -90 and 90 and a.longitude_deg between -180 and 180 then cast(a.longitude_deg as double) end as lon,
  case when a.latitude_deg between -90 and 90 and a.longitude_deg between -180 and 180 then cast(a.latitude_deg as double) end as lat
from f_airports a left join f_countries c on c.code = a.iso_country left join f_regions r on r.code = a.iso_region""",
     ["f_airports", "f_countries", "f_regions"])


def register(oracle):
    oracle("clean_airlines", "select * from s_airlines", ["s_airlines"])
    oracle("clean_flights", "select * from s_clean_flights", ["s_clean_flights"])
    oracle("clean_passengers", "select * from s_passengers", ["s_passengers"])
    oracle("booking_resolve", "select * from s_bookings", ["s_bookings"])
    oracle("baggage_latest", "select * from s_baggage", ["s_baggage"])
    oracle("clean_cargo", "select * replace (cast(peso_kg as double) as peso_kg, cast(volumen_m3 as double) as volumen_m3) from s_cargo", ["s_cargo"])
    oracle("cargo_enrich", "select * replace (cast(peso_kg as double) as peso_kg, cast(volumen_m3 as double) as volumen_m3) from s_cargo_enriched", ["s_cargo_enriched"])
    oracle("clean_crew", """select * replace (cast(horas_vuelo_duty as double) as horas_vuelo_duty, cast(descanso_horas as double) as descanso_horas,
        cast(descanso_minimo_requerido as double) as descanso_minimo_requerido) from s_crew""", ["s_crew"])
    oracle("crew_quarantine", """select * replace (cast(horas_vuelo_duty as double) as horas_vuelo_duty, cast(descanso_horas as double) as descanso_horas,
        cast(descanso_minimo_requerido as double) as descanso_minimo_requerido) from s_crew_judged where regla is not null""", ["s_crew_judged"])
    oracle("synth_fleet", "select * from s_synth_fleet", ["s_synth_fleet"])
    oracle("inline_values_anti_insert", """
select matricula, tipo, configuracion_asientos, 'FLEET' as origen from f_aircraft
union all
select i.matricula, i.tipo, i.configuracion_asientos, 'INLINE' from s_inline_aircraft i
where not exists (select 1 from f_aircraft a where a.matricula = i.matricula)""", ["f_aircraft", "s_inline_aircraft"])
    oracle("fallback_lookup", "select * exclude (iata_code) from s_workshops", ["s_workshops"])
    oracle("engines_cross", "select * from s_engines", ["s_engines"])
    oracle("first_child_by_order", "select aeronave_id, arg_min(motor_id, posicion) as motor_id from s_engines group by aeronave_id", ["s_engines"])
    oracle("clean_maintenance", "select * replace (cast(horas_aeronave as double) as horas_aeronave, cast(costo_usd as double) as costo_usd) from s_maintenance", ["s_maintenance"])
    oracle("clean_fuel", """select * replace (cast(litros as double) as litros, cast(densidad_kgl as double) as densidad_kgl,
        cast(masa_kg as double) as masa_kg, cast(precio_usd_litro as double) as precio_usd_litro,
        cast(costo_total_usd as double) as costo_total_usd) from s_fuel""", ["s_fuel"])
    oracle("clean_positions", "select * from s_positions", ["s_positions"])
    oracle("clean_sensors", """select * replace (cast(n1_pct as double) as n1_pct, cast(n2_pct as double) as n2_pct,
        cast(egt_c as double) as egt_c, cast(fuel_flow_kgh as double) as fuel_flow_kgh, cast(vibration as double) as vibration)
        from s_sensors""", ["s_sensors"])
    oracle("clean_waypoints", """select * replace (cast(latitud_deg as double) as latitud_deg, cast(longitud_deg as double) as longitud_deg)
        from s_waypoints""", ["s_waypoints"])
    oracle("airport_fk_enrich", "select * from s_airport_fk", ["s_airport_fk"])
