"""DuckDB oracle for the remaining facts (K5-K16) and the views."""

from __future__ import annotations

from contrail.functions import codes
from contrail.oracle.ctes import _def
from contrail.oracle.det_sql import AVG_DEC, DIV_DEC, PCT_DEC, U
from contrail.oracle.gold_sql import MAP_CASE, _q

_BIZ = ", ".join(_q(c) for c in codes.BUSINESS_CATEGORIES)
_k = "pasajero_id"
_def("g_dim_segment", f"""
select pasajero_id, left(coalesce(cast(null as varchar), 'NONE'), 10) as categoria_fidelidad,
  case when upper(categoria) in ({_BIZ}) then 'BUSINESS' when {U(_k, 'mice')} < 0.10 then 'MICE'
       when {U(_k, 'vfr')} < 0.25 then 'VFR' else 'LEISURE' end as segmento,
  case when upper(categoria) in ('PLATINUM', 'DIAMOND') then 'ALTA' when upper(categoria) in ('GOLD', 'SILVER') then 'MEDIA'
       else 'BAJA' end as frecuencia_anual,
  cast(round(cast(case when upper(categoria) in ('FIRST', 'PLATINUM', 'DIAMOND') then 10000 + {U(_k, 'val')} * 40000
                       when upper(categoria) in ('GOLD', 'EXEC') then 5000 + {U(_k, 'val')} * 15000
                       when upper(categoria) = 'SILVER' then 2000 + {U(_k, 'val')} * 5000
                       else 500 + {U(_k, 'val')} * 2000 end as decimal(18,6)), 2) as double) as valor_estimado_usd
from f_passengers""", ["f_passengers"])

_def("g_dim_crew_role", "select * from (values " + ", ".join(
    f"({a}, {_q(b)}, {_q(c)}, {d}, {e})" for a, b, c, d, e in codes.CREW_ROLE_DIM)
     + ") t(rol_id, rol, tipo, minimo_descanso_horas, maximo_duty_horas)")

_k = "pv.pv_id"
_def("g_fact_passenger", f"""
select pv.pv_id, pv.vuelo_id, hv.tiempo_id, hv.ruta_id, pv.pasajero_id, 1 as pax_count,
  round(hv.distance_flown_km, 2) as revenue_pax_km,
  round(cast(pv.tarifa_usd as double) / (case when hv.distance_flown_km <> 0 then hv.distance_flown_km end), 4) as yield_usd_rpk,
  least({DIV_DEC('hv.pax_transportados * 100', 'hv.asientos_ofrecidos', 0, 0, 18, 2)}, 100.0) as load_factor_pct,
  coalesce(pv.equipaje_piezas, cast(floor({U(_k, 'bc')} * 2) + 1 as integer)) as baggage_count,
  cast(coalesce(pv.peso_equipaje_kg, cast(10 + {U(_k, 'bw')} * 20 as decimal(8,2))) as double) as baggage_weight_kg,
  case when {U(_k, 'lost')} < 0.005 then 1 else 0 end as baggage_lost_count,
  case when {U(_k, 'upg')} < 0.03 then 1 else 0 end as upgrade_count,
  case when {U(_k, 'dng')} < 0.01 then 1 else 0 end as downgrade_count,
  case when {U(_k, 'ast')} < 0.05 then 1 else 0 end as special_assistance_count
from f_bookings pv join g_fact_flight hv on hv.vuelo_id = pv.vuelo_id
join g_dim_segment dps on dps.pasajero_id = pv.pasajero_id
where pv.pasajero_id is not null""", ["f_bookings", "g_fact_flight", "g_dim_segment"])

_k = "pv_id"
_def("g_fact_passenger_filled", f"""
select * replace (case when yield_usd_rpk is null and revenue_pax_km > 0 then round(
  (case when revenue_pax_km < 1500 then 200 + {U(_k, 'yf')} * 250 when revenue_pax_km < 4000 then 400 + {U(_k, 'yf')} * 400
        when revenue_pax_km < 8000 then 700 + {U(_k, 'yf')} * 600 else 1200 + {U(_k, 'yf')} * 800 end) / revenue_pax_km, 4)
  else yield_usd_rpk end as yield_usd_rpk)
from g_fact_passenger""", ["g_fact_passenger"])

_row = "(c.awb || '|' || cast(c.vuelo_id as varchar))"
_rate = (f"case c.tipo when 'GENERAL' then 2.0 + {U(_row, 'cr')} * 1.5 when 'PERECIBLE' then 3.5 + {U(_row, 'cr')} * 2.0 "
         f"when 'PELIGROSA' then 5.0 + {U(_row, 'cr')} * 3.0 when 'VALORADA' then 8.0 + {U(_row, 'cr')} * 5.0 "
         f"when 'ANIMALES' then 6.0 + {U(_row, 'cr')} * 3.0 else 2.44 end")
_yr = f"cast({MAP_CASE('c.tipo', codes.CARGO_YIELD_RATE, codes.CARGO_YIELD_DEFAULT)} as decimal(6,2))"
_cnts = ", ".join(f"cast(count(*) filter (where c.tipo = {_q(t)}) as integer) as n_{t.lower()}" for t in codes.CARGO_TYPES)
_def("g_fact_cargo_agg", f"""
select cast(strftime(v.salida_programada, '%Y%m%d') as integer) as tiempo_id, v.ruta_id, v.distancia_km,
  sum(c.peso_kg) as w, sum(c.volumen_m3) as vol,
  sum(cast(c.peso_kg * ({_rate}) as decimal(18,4))) as rev,
  sum(c.peso_kg * {_yr}) as yw, {_cnts}
from s_cargo c join g_route_lookup v on v.vuelo_id = c.vuelo_id
join g_dim_calendar dt on dt.tiempo_id = cast(strftime(v.salida_programada, '%Y%m%d') as integer)
where c.peso_kg > 0 and v.salida_programada is not null
group by 1, 2, 3""", ["s_cargo", "g_route_lookup", "g_dim_calendar"])

_key = "(cast(tiempo_id as varchar) || '|' || cast(ruta_id as varchar))"
_json = ("'{' || " + " || ',' || ".join(f"'\"{t}\":' || cast(n_{t.lower()} as varchar)" for t in codes.CARGO_TYPES)
         + " || ',\"TOTAL_KG\":' || cast(round(w, 2) as varchar) || '}'")
_cc = ", ".join(f"n_{t.lower()} as count_{t.lower()}" for t in codes.CARGO_TYPES)
_def("g_fact_cargo", f"""
select tiempo_id, ruta_id, cast(round(w, 2) as double) as cargo_weight_kg, cast(round(vol, 2) as double) as cargo_volume_m3,
  cast(round(rev, 2) as double) as cargo_revenue_usd,
  round(cast(yw as double) / (case when w * distancia_km <> 0 then cast(w as double) * distancia_km end), 4) as yield_usd_kgkm,
  {_json} as cargo_type_breakdown, {_cc},
  n_perecible as perishable_count, n_peligrosa as dangerous_goods_count,
  case when {U(_key, 'hold')} < 0.05 then 1 else 0 end as customs_hold_count,
  round(0.5 + {U(_key, 'clr')} * 2.5, 2) as clearance_time_avg_hours
from g_fact_cargo_agg""", ["g_fact_cargo_agg"])

_k = "cb.fuel_id"
_pax = "greatest(coalesce(hv.hv_pax, 150), 100)"
_def("g_fact_fuel", f"""
select cb.fuel_id, cb.vuelo_id, cast(strftime(v.salida_programada, '%Y%m%d') as integer) as tiempo_id,
  v.origen_id as aeropuerto_id, v.aeronave_id, v.ruta_id,
  cast(round(cb.masa_kg, 2) as double) as fuel_uplift_kg,
  cast(round(cast(cb.masa_kg * (0.92 + {U(_k, 'cons')} * 0.06) as decimal(18,4)), 2) as double) as fuel_consumed_kg,
  {DIV_DEC('cb.costo_total_usd', 'cb.masa_kg', 2, 3, 18, 4)} as fuel_price_avg_usd_kg,
  cast(round(cb.costo_total_usd, 2) as double) as fuel_cost_total_usd,
  least(round(cast(cb.masa_kg as double) / (case when v.distancia_km <> 0 then v.distancia_km end), 4), 99.9999) as efficiency_kg_km,
  round(-5 + {U(_k, 'var')} * 10, 2) as efficiency_variation_pct,
  least(round(cast(cb.masa_kg as double) * 3.16 / (case when {_pax} * v.distancia_km <> 0 then {_pax} * v.distancia_km end), 4), 99.9999) as co2_per_pax_km,
  round({U(_k, 'saf')} * 3, 2) as alternative_fuel_pct
from g_fuel_all cb
join g_route_lookup v on v.vuelo_id = cb.vuelo_id
join g_dim_aircraft dan on dan.aeronave_id = v.aeronave_id
join g_dim_calendar dt on dt.tiempo_id = cast(strftime(v.salida_programada, '%Y%m%d') as integer)
left join (select vuelo_id, pax_transportados as hv_pax from g_fact_flight) hv on hv.vuelo_id = cb.vuelo_id
where cb.masa_kg > 0 and cb.costo_total_usd > 0 and v.salida_programada is not null""",
     ["g_fuel_all", "g_route_lookup", "g_dim_aircraft", "g_dim_calendar", "g_fact_flight"])

_k = "m.evento_id"
_c = "m.tipo_check"
_def("g_fact_maintenance", f"""
select m.evento_id, cast(strftime(m.fecha_inicio, '%Y%m%d') as integer) as tiempo_id, m.aeronave_id, m.tipo_check,
  1 as events_count,
  least(round(case {_c} when 'A' then 40 + {U(_k, 'mh')} * 60 when 'B' then 100 + {U(_k, 'mh')} * 200
                        when 'C' then 300 + {U(_k, 'mh')} * 500 when 'D' then 800 + {U(_k, 'mh')} * 400
                        when 'LINE' then 2 + {U(_k, 'mh')} * 8 else 10 + {U(_k, 'mh')} * 30 end, 2), 9999.99) as man_hours,
  cast(round(cast(m.costo_usd * (0.50 + {U(_k, 'lab')} * 0.20) as decimal(18,4)), 2) as double) as cost_labor_usd,
  cast(round(cast(m.costo_usd * (0.30 + {U(_k, 'par')} * 0.20) as decimal(18,4)), 2) as double) as cost_parts_usd,
  cast(round(m.costo_usd, 2) as double) as cost_total_usd,
  least(round((epoch(m.fecha_fin) - epoch(m.fecha_inicio)) / 3600, 2), 9999.99) as aog_hours,
  cast(case when {_c} in ('C', 'D') then floor(60 + {U(_k, 'dl')} * 240) when {_c} = 'B' then floor(15 + {U(_k, 'dl')} * 90)
            when {_c} = 'A' then floor({U(_k, 'dl')} * 60) when {U(_k, 'dl_line')} < 0.10 then floor(5 + {U(_k, 'dl')} * 30)
            else 0 end as integer) as delay_caused_min,
  cast(case when {_c} in ('C', 'D') then floor({U(_k, 'df')} * 4) when {_c} = 'B' then floor({U(_k, 'df')} * 2)
            when {U(_k, 'df_o')} < 0.05 then 1 else 0 end as integer) as deferrals_count,
  cast(case upper(m.estado) when 'CLOSED' then floor(1 + {U(_k, 'cc')} * 3) when 'INPROGRESS' then floor({U(_k, 'cc')} * 2)
            else 0 end as integer) as component_changes_count
from s_maintenance m join g_dim_aircraft da on da.aeronave_id = m.aeronave_id
join g_dim_calendar dt on dt.tiempo_id = cast(strftime(m.fecha_inicio, '%Y%m%d') as integer)
where m.aeronave_id is not null and m.fecha_inicio is not null and m.fecha_fin is not null and m.costo_usd is not null""",
     ["s_maintenance", "g_dim_aircraft", "g_dim_calendar"])

_key = "(cast(tiempo_id as varchar) || '|' || cast(rol_id as varchar) || '|' || rol)"
_pd = "case upper(rol) " + " ".join(f"when {_q(r)} then {b} + {U(_key, 'pd')} * {s}" for r, b, s in codes.PER_DIEM) \
      + f" else 12 + {U(_key, 'pd')} * 6 end"
_def("g_fact_crew", f"""
select tiempo_id, rol_id, rol, crew_count,
  least(cast(round(duty, 2) as double), 9999.99) as duty_hours,
  least(round(cast(duty as double) * (0.70 + {U(_key, 'fh')} * 0.15), 2), 9999.99) as flight_hours,
  least(cast(round(rest, 2) as double), 9999.99) as layover_hours,
  round(cast(duty as double) * ({_pd}), 2) as per_diem_cost_usd,
  least(round(cast(duty as double) * (0.05 + {U(_key, 'tr')} * 0.05), 2), 9999.99) as training_hours,
  fatigue_events,
  least({DIV_DEC('ok * 100', 'crew_count', 0, 0, 15, 2)}, 100.0) as crew_pairing_efficiency_pct
from (
  select cast(strftime(v.salida_programada, '%Y%m%d') as integer) as tiempo_id, r.rol_id, tv.rol,
    cast(count(*) as integer) as crew_count, sum(tv.horas_vuelo_duty) as duty, sum(tv.descanso_horas) as rest,
    cast(sum(case when tv.descanso_horas < tv.descanso_minimo_requerido then 1
                  when {U('tv.roster_id', 'fat')} < 0.02 then 1 else 0 end) as integer) as fatigue_events,
    sum(case when tv.descanso_minimo_cumple then 1 else 0 end) as ok
  from s_crew tv join f_flights v on v.vuelo_id = tv.vuelo_id
  join g_dim_crew_role r on r.rol = upper(tv.rol)
  join g_dim_calendar dt on dt.tiempo_id = cast(strftime(v.salida_programada, '%Y%m%d') as integer)
  where tv.vuelo_id is not null and tv.horas_vuelo_duty is not null and tv.descanso_horas is not null
    and v.salida_programada is not null
  group by 1, 2, 3)""", ["s_crew", "f_flights", "g_dim_crew_role", "g_dim_calendar"])

_def("g_latest_position", """
select * exclude (rn) from (
  select posicion_id, vuelo_id, timestamp_utc, lon, lat, z_m, velocidad_nudos, heading, fase_vuelo,
    row_number() over (partition by vuelo_id order by timestamp_utc desc, posicion_id) as rn
  from s_positions)
where rn = 1""", ["s_positions"])

_def("g_ap_code", """
select aeropuerto_id, coalesce(nullif(iata, ''), nullif(icao, ''), ident) as code, ident from f_airports""", ["f_airports"])


def MIN(a, b):
    return f"((epoch_us({a}) - epoch_us({b})) / 6e7)"


def register(oracle):
    oracle("dim_passenger_segment", "select * from g_dim_segment", ["g_dim_segment"])
    oracle("dim_crew_role", "select * from g_dim_crew_role", ["g_dim_crew_role"])
    oracle("fuel_backfill", """select * replace (cast(litros as double) as litros, cast(densidad_kgl as double) as densidad_kgl,
        cast(masa_kg as double) as masa_kg, cast(precio_litro_usd as double) as precio_litro_usd,
        cast(costo_total_usd as double) as costo_total_usd) from g_fuel_backfill""", ["g_fuel_backfill"])
    oracle("fact_passenger", "select * from g_fact_passenger", ["g_fact_passenger"])
    oracle("fact_passenger_yield_fill", "select pv_id, revenue_pax_km, yield_usd_rpk from g_fact_passenger_filled",
           ["g_fact_passenger_filled"])
    oracle("fact_cargo", "select * from g_fact_cargo", ["g_fact_cargo"])
    oracle("fact_fuel", "select * from g_fact_fuel", ["g_fact_fuel"])
    oracle("fact_maintenance", "select * from g_fact_maintenance", ["g_fact_maintenance"])
    oracle("fact_crew", "select * from g_fact_crew", ["g_fact_crew"])
    oracle("flight_operations_view", f"""
select v.vuelo_id, v.numero_vuelo, al.nombre as aerolinea, al.codigo_iata, al.codigo_icao, an.matricula,
  an.tipo as tipo_aeronave, an.estado as estado_aeronave, ao.nombre as aeropuerto_origen, ao.iata as origen_iata,
  ao.icao as origen_icao, ad.nombre as aeropuerto_destino, ad.iata as destino_iata, ad.icao as destino_icao,
  av.codigo as aerovia, v.salida_programada, v.llegada_programada, v.salida_real, v.llegada_real, v.estado,
  v.motivo_desviacion,
  round({MIN('v.llegada_real', 'v.salida_real')}, 2) as duracion_real_min,
  round({MIN('v.salida_real', 'v.salida_programada')}, 2) as delay_salida_min,
  round({MIN('v.llegada_real', 'v.llegada_programada')}, 2) as delay_llegada_min,
  coalesce(pv.pasajeros_totales, 0) as pasajeros_totales,
  cast(coalesce(pv.piezas, 0) as bigint) as equipaje_total_piezas,
  cast(coalesce(pv.kg, 0) as double) as equipaje_total_kg,
  cast(coalesce(pv.rev, 0) as double) as revenue_pasajeros_usd,
  cast(coalesce(cv.kg, 0) as double) as carga_total_kg,
  cast(round(coalesce(cv.kg, 0) * 2.5, 2) as double) as carga_revenue_estimado
from f_flights v
left join s_airline_dim al on al.aerolinea_id = v.aerolinea_id
left join f_aircraft an on an.aeronave_id = v.aeronave_id
left join f_airports ao on ao.aeropuerto_id = v.origen_id
left join f_airports ad on ad.aeropuerto_id = v.destino_id
left join f_airways av on av.aerovia_id = v.vuelo_id % 75
left join (select vuelo_id, count(distinct pasajero_id) as pasajeros_totales, sum(coalesce(equipaje_piezas, 0)) as piezas,
                  sum(coalesce(peso_equipaje_kg, 0)) as kg, sum(coalesce(tarifa_usd, 0)) as rev
           from f_bookings group by vuelo_id) pv on pv.vuelo_id = v.vuelo_id
left join (select vuelo_id, sum(coalesce(peso_kg, 0)) as kg from s_cargo group by vuelo_id) cv on cv.vuelo_id = v.vuelo_id""",
           ["f_flights", "s_airline_dim", "f_aircraft", "f_airports", "f_airways", "f_bookings", "s_cargo"])
    oracle("active_maintenance", f"""
select me.evento_id, me.aeronave_id, me.motor_id, me.taller_id, a.matricula, a.tipo as tipo_aeronave,
  a.estado as estado_aeronave, mo.modelo as modelo_motor, mo.serial_number, mo.horas_acumuladas, mo.ciclos_acumulados,
  tm.nombre as taller_nombre, tm.tipo as taller_tipo, me.tipo_check, me.componente, me.descripcion, me.tecnico_id,
  me.fecha_inicio, me.fecha_fin,
  round({MIN("coalesce(me.fecha_fin, timestamp '2024-02-01 00:00:00')", 'me.fecha_inicio')} / 60, 2) as duracion_horas,
  cast(me.costo_usd as double) as costo_usd, me.estado,
  me.estado in ('OPEN', 'INPROGRESS') as mantenimiento_activo,
  (a.estado = 'MANTENIMIENTO' and me.estado in ('OPEN', 'INPROGRESS')) as aeronave_aog
from s_maintenance me
left join f_aircraft a on a.aeronave_id = me.aeronave_id
left join s_engines mo on mo.motor_id = me.motor_id
left join s_workshops tm on tm.taller_id = me.taller_id
where me.estado in ('OPEN', 'INPROGRESS', 'DEFERRED')
order by me.fecha_inicio desc, me.evento_id""", ["s_maintenance", "f_aircraft", "s_engines", "s_workshops"])
    now = "timestamp '2024-01-15 12:00:00'"
    oracle("notam_status", f"""
select n.notam_id, n.ident, n.tipo, n.aeropuerto_id, a.nombre as aeropuerto_nombre, a.iata, a.icao, a.municipality,
  a.iso_country, n.radio_nm, n.altura_min, n.valido_desde, n.valido_hasta,
  round({MIN('n.valido_hasta', now)} / 60, 2) as horas_restantes,
  case when {now} between n.valido_desde and n.valido_hasta then 'ACTIVO' when {now} < n.valido_desde then 'PROGRAMADO'
       else 'EXPIRADO' end as estado_notam,
  coalesce({now} between n.valido_desde and n.valido_hasta, false) as activo
from f_notams n left join f_airports a on a.aeropuerto_id = n.aeropuerto_id
order by n.valido_desde desc, n.notam_id""", ["f_notams", "f_airports"])
    oracle("masked_passengers", """
select pasajero_id, '***MASKED***' as documento, '***' as tipo_doc, 'PASAJERO ANONIMO' as nombre, nacionalidad, categoria,
  cast(date_part('year', age(date '2026-01-01', fecha_nacimiento)) as integer) as edad_aproximada
from f_passengers""", ["f_passengers"])
    oracle("latest_position", """
select p.*, v.numero_vuelo, v.aeronave_id from g_latest_position p join f_flights v on v.vuelo_id = p.vuelo_id""",
           ["g_latest_position", "f_flights"])
    oracle("flight_status_view", """
select v.vuelo_id, v.numero_vuelo, al.nombre as aerolinea, ao.code as origen, ad.code as destino, v.estado,
  v.salida_programada, v.llegada_programada, v.salida_real, v.llegada_real,
  pos.timestamp_utc as ultima_actualizacion, pos.lon, pos.lat, pos.velocidad_nudos, pos.fase_vuelo,
  tv.roster_id, tv.rol, tv.duty_start, tv.duty_end
from f_flights v join s_airline_dim al on al.aerolinea_id = v.aerolinea_id
join g_ap_code ao on ao.aeropuerto_id = v.origen_id join g_ap_code ad on ad.aeropuerto_id = v.destino_id
left join g_latest_position pos on pos.vuelo_id = v.vuelo_id
left join s_crew tv on tv.vuelo_id = v.vuelo_id""", ["f_flights", "s_airline_dim", "g_ap_code", "g_latest_position", "s_crew"])
    oracle("passenger_connections", """
select p.pasajero_id, p.nombre, pv.pv_id, v.numero_vuelo, ao.code as origen, ad.code as destino, v.llegada_programada,
  lead(v.numero_vuelo) over (partition by p.pasajero_id order by v.salida_programada, v.vuelo_id, pv.pv_id, pv.clase, pv.tarifa_usd)
    as siguiente_vuelo
from f_passengers p join f_bookings pv on pv.pasajero_id = p.pasajero_id join f_flights v on v.vuelo_id = pv.vuelo_id
join g_ap_code ao on ao.aeropuerto_id = v.origen_id join g_ap_code ad on ad.aeropuerto_id = v.destino_id""",
           ["f_passengers", "f_bookings", "f_flights", "g_ap_code"])
    oracle("baggage_trace", """
select e.tag_id, e.estado, e.ubicacion_actual, e.timestamp_ultimo_evento, v.numero_vuelo, ao.code as origen, ad.code as destino
from s_baggage e join f_flights v on v.vuelo_id = e.vuelo_id
join g_ap_code ao on ao.aeropuerto_id = v.origen_id join g_ap_code ad on ad.aeropuerto_id = v.destino_id""",
           ["s_baggage", "f_flights", "g_ap_code"])
    oracle("customs_pending", """
select c.awb, c.tipo, cast(c.peso_kg as double) as peso_kg, ao.ident as origen, ad.ident as destino,
  json_extract_string(c.declaracion_aduanera, '$.commodity') as commodity,
  cast(cast(json_extract_string(c.declaracion_aduanera, '$.customs_value_usd') as decimal(14,2)) as double) as customs_value_usd,
  cast(json_extract_string(c.declaracion_aduanera, '$.dangerous_goods') as boolean) as dangerous_goods
from s_cargo c join f_flights v on v.vuelo_id = c.vuelo_id
join f_airports ao on ao.aeropuerto_id = v.origen_id join f_airports ad on ad.aeropuerto_id = v.destino_id
where c.tiene_declaracion""", ["s_cargo", "f_flights", "f_airports"])
    oracle("crew_duty_hours", f"""
select crew_id, count(vuelo_id) as vuelos_asignados, cast(sum(horas_vuelo_duty) as double) as horas_totales_duty,
  {AVG_DEC('descanso_horas', 2, 4)} as descanso_promedio, bool_and(descanso_minimo_cumple) as cumple_regulacion
from s_crew group by crew_id""", ["s_crew"])
    oracle("engine_health", f"""
select engine_id, {AVG_DEC('egt_c', 2, 4)} as temperatura_promedio,
  {AVG_DEC('vibration', 3, 4)} as vibracion_promedio,
  {AVG_DEC('fuel_flow_kgh', 2, 4)} as combustible_promedio,
  max(timestamp_utc) as ultimo_sensor, count(*) as total_lecturas, count(vibration) as lecturas_vibracion,
  case when avg(vibration) > 5 or avg(egt_c) > 900 then 'REQUIERE_INSPECCION' else 'OPERACION_NORMAL' end as estado_predictivo
from s_sensors group by engine_id""", ["s_sensors"])
    oracle("cargo_demand_by_route", f"""
select r.origen_icao, r.destino_icao, t.anio, t.mes, count(*) as total_envios,
  round(sum(hc.cargo_weight_kg), 2) as peso_total_kg, round(sum(hc.cargo_volume_m3), 2) as volumen_total_m3,
  round(sum(hc.cargo_revenue_usd), 2) as revenue_total_usd, {AVG_DEC('hc.yield_usd_kgkm', 4, 4)} as promedio_yield,
  sum(hc.perishable_count) as carga_perecible, sum(hc.dangerous_goods_count) as carga_peligrosa,
  sum(hc.customs_hold_count) as retenciones_aduana
from g_fact_cargo hc join g_dim_route r on r.ruta_id = hc.ruta_id join g_dim_calendar t on t.tiempo_id = hc.tiempo_id
group by r.origen_icao, r.destino_icao, t.anio, t.mes""", ["g_fact_cargo", "g_dim_route", "g_dim_calendar"])
    oracle("customs_summary", f"""
select t.anio, t.mes, r.origen_icao, r.destino_icao, r.mercado, count(*) as total_operaciones_carga,
  round(sum(hc.cargo_weight_kg), 2) as peso_total_kg, round(sum(hc.cargo_revenue_usd), 2) as revenue_total_usd,
  {AVG_DEC('hc.clearance_time_avg_hours', 2, 4)} as promedio_despacho_horas,
  sum(hc.customs_hold_count) as total_retenciones_aduana, sum(hc.perishable_count) as mercancia_perecible,
  sum(hc.dangerous_goods_count) as mercancia_peligrosa, {AVG_DEC('hc.yield_usd_kgkm', 4, 4)} as yield_promedio_kgkm
from g_fact_cargo hc join g_dim_route r on r.ruta_id = hc.ruta_id join g_dim_calendar t on t.tiempo_id = hc.tiempo_id
group by t.anio, t.mes, r.origen_icao, r.destino_icao, r.mercado""", ["g_fact_cargo", "g_dim_route", "g_dim_calendar"])
    oracle("fuel_efficiency_monthly", f"""
select da.tipo as tipo_aeronave, da.fabricante, t.anio, t.mes, count(*) as total_operaciones,
  round(sum(hc.fuel_consumed_kg), 2) as combustible_total_kg, {AVG_DEC('hc.efficiency_kg_km', 4, 4)} as eficiencia_promedio_kg_km,
  {AVG_DEC('hc.co2_per_pax_km', 4, 4)} as co2_promedio_pax_km, {AVG_DEC('hc.alternative_fuel_pct', 2, 4)} as promedio_saf_pct,
  round(sum(hc.fuel_cost_total_usd), 2) as costo_total_combustible_usd
from g_fact_fuel hc join g_dim_aircraft da on da.aeronave_id = hc.aeronave_id join g_dim_calendar t on t.tiempo_id = hc.tiempo_id
group by da.tipo, da.fabricante, t.anio, t.mes""", ["g_fact_fuel", "g_dim_aircraft", "g_dim_calendar"])
    oracle("safety_summary", """
select m.anio, m.mes, m.trimestre, coalesce(hv.total_vuelos, 0) as total_vuelos,
  cast(ht.eventos_fatiga as bigint) as eventos_fatiga,
  coalesce(svm.vuelos_desviados, 0) as vuelos_desviados, coalesce(svm.vuelos_cancelados, 0) as vuelos_cancelados,
  coalesce(dev.desviaciones_ruta_criticas, 0) as desviaciones_ruta_criticas,
  coalesce(hv.incidentes_operacionales, 0) as incidentes_operacionales, ht.eficiencia_tripulacion_pct
from q_months m left join q_hv hv using (anio, mes) left join q_ht ht using (anio, mes) left join q_svm svm using (anio, mes)
left join q_dev dev using (anio, mes)""", ["g_dim_calendar", "g_fact_flight", "g_fact_crew", "f_flights", "s_positions"], extra=[
        ("q_months", "select distinct anio, mes, trimestre from g_dim_calendar"),
        ("q_hv", """select t.anio, t.mes, count(*) as total_vuelos,
              count(distinct case when hv.delay_min > 120 then hv.vuelo_id end) as incidentes_operacionales
       from g_fact_flight hv join g_dim_calendar t on t.tiempo_id = hv.tiempo_id group by 1, 2"""),
        ("q_ht", f"""select t.anio, t.mes, sum(fatigue_events) as eventos_fatiga,
              {AVG_DEC('crew_pairing_efficiency_pct', 2, 4)} as eficiencia_tripulacion_pct
       from g_fact_crew ht join g_dim_calendar t on t.tiempo_id = ht.tiempo_id group by 1, 2"""),
        ("q_sv", """select vuelo_id, estado, year(salida_programada) as anio, month(salida_programada) as mes
       from f_flights where estado in ('DIVERTED', 'CANCEL')"""),
        ("q_svm", """select anio, mes, count(distinct case when estado = 'DIVERTED' then vuelo_id end) as vuelos_desviados,
               count(distinct case when estado = 'CANCEL' then vuelo_id end) as vuelos_cancelados from q_sv group by 1, 2"""),
        ("q_dev", """select sv.anio, sv.mes, count(distinct p.posicion_id) as desviaciones_ruta_criticas
        from s_positions p join q_sv sv on sv.vuelo_id = p.vuelo_id where p.desviacion_nm > 50 group by 1, 2""")])
    oracle("otp_by_airport", f"""
select da.aeropuerto_id, da.iata, da.icao, da.nombre as aeropuerto_nombre, da.ciudad, da.pais, t.anio, t.mes,
  count(hv.vuelo_id) as vuelos_totales,
  count(*) filter (where hv.delay_min <= 15) as vuelos_puntuales,
  count(*) filter (where hv.delay_min > 15) as vuelos_demorados,
  {PCT_DEC('count(*) filter (where hv.delay_min <= 15)', 'count(hv.vuelo_id)')} as otp_pct,
  {AVG_DEC('hv.delay_min', 0, 2)} as delay_promedio_min,
  cast(round(sum(hv.total_revenue_usd), 2) as double) as revenue_total_usd,
  cast(round(sum(hv.co2_emitted_ton), 2) as double) as co2_emitido_ton
from g_fact_flight hv join g_dim_calendar t on t.tiempo_id = hv.tiempo_id
join g_dim_route dr on dr.ruta_id = hv.ruta_id join g_dim_airport da on da.icao = dr.origen_icao
group by da.aeropuerto_id, da.iata, da.icao, da.nombre, da.ciudad, da.pais, t.anio, t.mes
order by t.anio desc, t.mes desc, otp_pct desc nulls last, da.aeropuerto_id""",
           ["g_fact_flight", "g_dim_calendar", "g_dim_route", "g_dim_airport"])
    oracle("route_occupancy", f"""
select dr.ruta_id, dr.origen_icao, dr.destino_icao, dr.tipo_ruta, dr.mercado, t.anio, t.mes,
  count(hv.vuelo_id) as vuelos_operados, sum(hv.asientos_ofrecidos) as asientos_ofrecidos,
  sum(hv.asientos_vendidos) as asientos_vendidos, sum(hv.pax_transportados) as pasajeros_transportados,
  cast(round(sum(cast(hv.distance_flown_km as decimal(14,2))), 2) as double) as distancia_total_km,
  cast(round(sum(hv.asientos_ofrecidos * cast(hv.distance_flown_km as decimal(14,2))), 2) as double) as ask_total,
  cast(round(sum(hv.pax_transportados * cast(hv.distance_flown_km as decimal(14,2))), 2) as double) as rpk_total,
  {DIV_DEC('sum(hv.pax_transportados * cast(hv.distance_flown_km as decimal(14,2))) * 100', 'sum(hv.asientos_ofrecidos * cast(hv.distance_flown_km as decimal(14,2)))', 2, 2, 6, 2)} as load_factor_pct,
  cast(round(sum(hv.passenger_revenue_usd), 2) as double) as passenger_revenue_usd,
  cast(round(sum(hv.total_revenue_usd), 2) as double) as total_revenue_usd,
  {DIV_DEC('sum(hv.passenger_revenue_usd)', 'sum(hv.pax_transportados * cast(hv.distance_flown_km as decimal(14,2)))', 2, 2, 10, 4)} as yield_usd_rpk
from g_fact_flight hv join g_dim_route dr on dr.ruta_id = hv.ruta_id join g_dim_calendar t on t.tiempo_id = hv.tiempo_id
group by dr.ruta_id, dr.origen_icao, dr.destino_icao, dr.tipo_ruta, dr.mercado, t.anio, t.mes
order by t.anio desc, t.mes desc, load_factor_pct desc nulls last, dr.ruta_id""", ["g_fact_flight", "g_dim_route", "g_dim_calendar"])
