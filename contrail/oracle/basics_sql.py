"""DuckDB oracle for sources, scalar functions, verification queries and join shapes."""

from __future__ import annotations

from contrail.oracle.det_sql import AVG_DEC, U
from contrail.oracle.silver_sql import PHASE


def register(oracle):
    oracle("scan_typed", """
select o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority from orders
where o_orderstatus in ('O', 'F', 'P')""", [])
    oracle("csv_catalog_load", "select * from f_countries", ["f_countries"])
    oracle("retype_columns", """
select cast(p_partkey as bigint) as id, cast(cast(p_size % 2 as integer) as boolean) as lighted,
  cast(case when p_size % 7 = 0 then null else cast(cast(p_retailprice as decimal(12,2)) as decimal(8,2)) end as double) as length_ft,
  cast(cast(p_size as decimal(10,2)) as double) as width_ft,
  p_name as superficie,
  coalesce(case when p_size % 5 = 0 then null else p_brand end, 'UNKN') as airport_ident,
  true as activo
from part""", [])
    oracle("json_extract", """
select reserva_id,
  json_extract_string(pasajero_json, '$.first_name') as first_name, json_extract_string(pasajero_json, '$.last_name') as last_name,
  json_extract_string(pasajero_json, '$.document_type') as document_type,
  json_extract_string(pasajero_json, '$.nationality') as nationality,
  cast(json_extract_string(pasajero_json, '$.frequent_flyer') as boolean) as frequent_flyer,
  json_extract_string(vuelos_json, '$.flight_number') as flight_number, json_extract_string(vuelos_json, '$.origin') as origin,
  json_extract_string(vuelos_json, '$.destination') as destination, json_extract_string(vuelos_json, '$.airline') as airline
from f_reservations""", ["f_reservations"])
    oracle("json_each", """
select aeronave_id, k as clase, cast(json_extract_string(configuracion_asientos, k) as integer) as asientos
from (select aeronave_id, configuracion_asientos, unnest(json_keys(configuracion_asientos)) as k from f_aircraft)""",
           ["f_aircraft"])
    oracle("json_build", """
select posicion_id,
  '{"callsign":"FL' || cast(vuelo_id as varchar) || '","source":"ADS-B",'
  || case when altitud_pies is null then '' else '"altitude_ft":' || cast(altitud_pies as varchar) || ',' end
  || '"emergency":' || case when aerovia_id = 0 then 'true' else 'false' end || '}' as raw_json
from f_positions""", ["f_positions"])
    oracle("xml_roundtrip", """
select vuelo_id,
  '<flight_plan><flight_rules>' || rules || '</flight_rules><flight_type>' || case when vuelo_id % 3 = 0 then 'N' else 'S' end
  || '</flight_type><origin>' || lpad(cast(origen_id as varchar), 4, '0') || '</origin><destination>'
  || lpad(cast(destino_id as varchar), 4, '0') || '</destination><aircraft_type>' || cast(aeronave_id as varchar)
  || '</aircraft_type></flight_plan>' as raw_xml,
  rules as flight_rules, lpad(cast(origen_id as varchar), 4, '0') as origin,
  lpad(cast(destino_id as varchar), 4, '0') as destination, cast(aeronave_id as integer) as aircraft_type
from (select *, case when vuelo_id % 4 = 0 then 'VFR' else 'IFR' end as rules from f_flights)""", ["f_flights"])
    oracle("series_numeric", """
select range as id, range * range as id_sq from range(1, (select count(*) from supplier) + 1)""", [])
    oracle("flight_phase", f"""
select p.posicion_id, cast(p.altitud_pies as double) as altitud_pies, p.velocidad_nudos, {PHASE} as fase_vuelo
from f_positions p""", ["f_positions"])
    oracle("string_functions", """
select vuelo_id, left(upper(trim(numero_vuelo)), 3) as prefijo, codigo_aerolinea || '-' || numero_vuelo as etiqueta,
  lpad(cast(vuelo_id as varchar), 3, '0') as id_lpad3, upper(substr(md5(cast(vuelo_id as varchar)), 1, 6)) as pnr_sintetico,
  length(numero_vuelo) as largo
from f_flights""", ["f_flights"])
    oracle("dq_airline_codes", """
select * from (with a as (
  select v.codigo_icao, k.codigo_iata, k.pais_codigo as pais_base
  from (select distinct regexp_extract(upper(trim(numero_vuelo)), '^([A-Z]+)', 1) as codigo_icao from f_flights) v
  left join s_airline_dim k on k.codigo_icao = v.codigo_icao
  where length(v.codigo_icao) > 0),
n as (select count(*) as filas, count(*) filter (length(trim(codigo_iata)) > 2) as iata,
  count(*) filter (length(trim(codigo_icao)) > 3) as icao, count(*) filter (length(trim(pais_base)) > 2) as pais from a)
select 'aerolineas' as tabla, 'codigo_iata' as regla, iata as violaciones, filas from n
union all select 'aerolineas', 'codigo_icao', icao, filas from n
union all select 'aerolineas', 'pais_base', pais, filas from n)""", ["f_flights", "s_airline_dim"])
    oracle("digits_from_text", """
select evento_id, tecnico_id, try_cast(nullif(regexp_replace(tecnico_id, '[^0-9]', '', 'g'), '') as integer) as tecnico_num
from f_maintenance""", ["f_maintenance"])
    oracle("datetime_functions", """
select vuelo_id, (epoch_us(llegada_programada) - epoch_us(salida_programada)) / 6e7 as block_min,
  round((epoch_us(salida_real) - epoch_us(salida_programada)) / 6e7 / 60, 4) as delay_h,
  salida_programada + to_hours(cast(vuelo_id % 5 as integer)) as mas_horas,
  cast(timezone('UTC', timezone('America/Costa_Rica', salida_programada)) as timestamp) as salida_utc_desde_cr,
  cast(llegada_programada as date) - cast(salida_programada as date) as dias
from f_flights""", ["f_flights"])
    oracle("math_functions", """
select l_orderkey, l_linenumber, l_partkey,
  cast(round(cast(l_extendedprice as decimal(12,2)) * cast(l_discount as decimal(4,2)), 2) as double) as descuento,
  cast(floor(l_quantity / 7) as bigint) as piso,
  cast(abs(cast(l_extendedprice as decimal(12,2)) - 30000) as double) as distancia_30k,
  cast(round(l_quantity / 4) as integer) as cuartos_redondeados,
  cast(trunc(l_quantity / 4) as integer) as cuartos_truncados
from lineitem""", [])
    k = "o_orderkey"
    oracle("seeded_uniform", f"""
select o_orderkey, {U(k, 'demo')} as u,
  case when {U(k, 's1')} < 0.60 then 'SCHED' when {U(k, 's2')} < 0.80 then 'ACTIVE' when {U(k, 's3')} < 0.95 then 'LANDED'
       when {U(k, 's4')} < 0.98 then 'DIVERTED' else 'CANCEL' end as estado_sintetico
from orders""", [])
    oracle("array_functions", """
select taller_id, nombre, unnest(certificaciones) as certificacion, list_contains(certificaciones, 'FAA-145') as tiene_faa,
  len(certificaciones) as n_cert, certificaciones[1] as primera
from s_workshops""", ["s_workshops"])
    oracle("conditional_functions", """
select vuelo_id, coalesce(salida_real, salida_programada) as salida_efectiva, nullif(numero_vuelo, '') as numero_o_nulo,
  least(origen_id, destino_id) as menor_aeropuerto,
  greatest((epoch_us(salida_real) - epoch_us(salida_programada)) / 6e7, 0.0) as retraso_no_negativo
from f_flights""", ["f_flights"])
    oracle("unit_conversions", """
select posicion_id, cast(altitud_pies * 0.3048 as double) as altitud_m, cast(round(altitud_pies / 100, 0) as integer) as nivel_vuelo,
  cast(desviacion_nm * 1852 as double) as desviacion_m, cast(desviacion_nm * 1.852 as double) as desviacion_km
from f_positions""", ["f_positions"])
    oracle("geo_points", """
select aeropuerto_id,
  case when v then cast(longitude_deg as double) end as st_x, case when v then cast(latitude_deg as double) end as st_y,
  case when v then cast(elevation_ft * 0.3048 as double) end as st_z
from (select *, latitude_deg between -90 and 90 and longitude_deg between -180 and 180 as v from f_airports)""",
           ["f_airports"])
    oracle("wkt_linestring_parse", """
select aerovia_id, wkt, 2 as n_vertices, cast(lon1 as double) as lon1, cast(lat1 as double) as lat1, cast(z1 as double) as z1,
  cast(lon2 as double) as lon2, cast(lat2 as double) as lat2, cast(z2 as double) as z2
from (select *, 'LINESTRING Z (' || cast(lon1 as varchar) || ' ' || cast(lat1 as varchar) || ' ' || cast(z1 as varchar) || ', '
        || cast(lon2 as varchar) || ' ' || cast(lat2 as varchar) || ' ' || cast(z2 as varchar) || ')' as wkt
      from (select *, cast(nivel_min * 100 * 0.3048 as decimal(12,4)) as z1, cast(nivel_max * 100 * 0.3048 as decimal(12,4)) as z2
            from f_airways))""", ["f_airways"])
    oracle("top_n_preview", """
select vuelo_id, delay_min, delay_code, ruta_id from g_fact_flight order by delay_min desc, vuelo_id limit 20""",
           ["g_fact_flight"])
    oracle("hash_sample", """
select pv_id, vuelo_id, pasajero_id, clase, cast(tarifa_usd as double) as tarifa_usd from f_bookings
order by md5(cast(pv_id as varchar) || '|' || cast(pasajero_id as varchar) || '|' || clase || '|' || cast(tarifa_usd as varchar) || '|sample'), pv_id
limit 5000""", ["f_bookings"])
    oracle("table_row_counts", """
select 'vuelos' as tabla, count(*) as filas from f_flights
union all select 'pasajeros_vuelo', count(*) from f_bookings
union all select 'carga_vuelo', count(*) from f_cargo
union all select 'tripulacion_vuelo', count(*) from f_crew
union all select 'combustible_carga', count(*) from f_fuel
union all select 'posicionamiento', count(*) from f_positions
union all select 'aeronaves', count(*) from f_aircraft
union all select 'motores', count(*) from s_engines
union all select 'talleres_mro', count(*) from s_workshops""",
           ["f_flights", "f_bookings", "f_cargo", "f_crew", "f_fuel", "f_positions", "f_aircraft", "s_engines", "s_workshops"])
    oracle("coverage_check", """
select w.codigo_icao, a.nombre, a.nombre is not null as existe
from (values ('AVA'), ('DAL'), ('UAL'), ('AAL'), ('IBE'), ('AFR'), ('KLM'), ('BAW'), ('CMP'), ('JBU'), ('QTR'), ('ACA'),
             ('SWA'), ('VOI'), ('JAL'), ('DLH'), ('LAN')) w(codigo_icao)
left join s_airlines a on a.codigo_icao = w.codigo_icao
order by w.codigo_icao""", ["s_airlines"])
    oracle("booking_profile", """
select count(*) as total_filas, count(distinct pnr) as pnrs_unicos, count(distinct vuelo_id) as vuelos_distintos,
  count(distinct pasajero_id) as pasajeros_distintos, sum(case when estado = 'BOARDED' then 1 else 0 end) as abordados
from s_bookings""", ["s_bookings"])
    oracle("crew_rollup", """
select rol, count(*) as total_filas, count(distinct vuelo_id) as vuelos_distintos, grouping(rol) as nivel
from s_crew group by rollup(rol)""", ["s_crew"])
    oracle("null_profile", """
select count(*) as total_eventos, count(taller_id) as con_taller, count(*) - count(taller_id) as sin_taller,
  count(motor_id) as con_motor, count(*) - count(motor_id) as sin_motor
from s_maintenance""", ["s_maintenance"])
    oracle("flights_by_year", """
select year(salida_programada) as anio, count(*) as vuelos from f_flights group by anio order by anio""", ["f_flights"])
    oracle("fuel_coverage", """
select (select count(*) from f_flights) as total_vuelos, (select count(*) from f_fuel) as registros_fuel,
  (select count(distinct vuelo_id) from f_fuel) as vuelos_distintos_con_fuel,
  (select count(distinct v.vuelo_id) from f_flights v left join f_fuel cb on cb.vuelo_id = v.vuelo_id
   where cb.vuelo_id is null) as vuelos_sin_fuel""", ["f_flights", "f_fuel"])
    oracle("yield_profile", f"""
select count(*) as total, count(yield_usd_rpk) as con_yield, count(*) - count(yield_usd_rpk) as sin_yield,
  {AVG_DEC('yield_usd_rpk', 4, 4)} as yield_promedio, round(min(yield_usd_rpk), 4) as yield_min,
  round(max(yield_usd_rpk), 4) as yield_max
from g_fact_passenger_filled""", ["g_fact_passenger_filled"])
    oracle("fact_cargo_totals", f"""
select count(*) as total_filas, count(distinct tiempo_id) as fechas_distintas, count(distinct ruta_id) as rutas_distintas,
  cast(round(sum(cast(cargo_weight_kg as decimal(18,2))), 2) as double) as peso_total_kg,
  cast(round(sum(cast(cargo_weight_kg as decimal(18,2))) / 1000, 2) as double) as toneladas_total,
  cast(round(sum(cast(cargo_revenue_usd as decimal(18,2))), 2) as double) as revenue_total,
  {AVG_DEC('yield_usd_kgkm', 4, 4)} as yield_promedio,
  sum(perishable_count) as perecibles_total, sum(dangerous_goods_count) as peligrosa_total,
  sum(customs_hold_count) as retenciones_aduana
from g_fact_cargo""", ["g_fact_cargo"])
    oracle("flights_without_fuel", """
select v.vuelo_id, v.numero_vuelo from f_flights v left join f_fuel cb on cb.vuelo_id = v.vuelo_id where cb.vuelo_id is null""",
           ["f_flights", "f_fuel"])
    oracle("join_json_key", """
select r.reserva_id, v.vuelo_id, v.numero_vuelo from f_reservations r
join f_flights v on v.numero_vuelo = json_extract_string(r.vuelos_json, '$.flight_number')""", ["f_reservations", "f_flights"])
    oracle("row_multiply", """
select reserva_id, pnr, bag_no, 'BG' || pnr || cast(bag_no as varchar) as tag_id
from f_reservations, (select unnest([1, 2]) as bag_no) b where pnr is not null""", ["f_reservations"])
    oracle("lateral_pick_other", f"""
with ap as (select aeropuerto_id, row_number() over (order by aeropuerto_id) - 1 as ix from f_airports),
o as (select aeropuerto_id, ix, cast(floor({U('aeropuerto_id', 'other')} * ((select count(*) from ap) - 1)) as bigint) as j0 from ap)
select o.aeropuerto_id as origen_id, d.aeropuerto_id as destino_id
from o join ap d on d.ix = case when o.j0 >= o.ix then o.j0 + 1 else o.j0 end""".replace("with ap as", "select * from (with ap as") + ")",
           ["f_airports"])
    oracle("keyed_random_pick", f"""
select v.vuelo_id, a.aeronave_id, a.matricula
from f_flights v
left join (select aeronave_id, matricula, row_number() over (order by aeronave_id) - 1 as ci from f_aircraft) a
  on a.ci = cast(floor({U('v.vuelo_id', 'pick_ac')} * (select count(*) from f_aircraft)) as bigint)""",
           ["f_flights", "f_aircraft"])
