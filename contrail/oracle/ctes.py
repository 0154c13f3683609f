"""DuckDB CTEs that rebuild the fixture views from the driver tables.

Written against the FIXTURES.md formulas; the Spark side lives in
``contrail.sources.fixtures``. ``with_ctes(body, deps)`` prefixes a query
with the CTEs it needs (transitively, in dependency order).
"""

from __future__ import annotations

from contrail.functions import codes
from contrail.oracle.det_sql import PICK, U

_AL = ", ".join(f"'{a[0]}'" for a in codes.AIRLINES)
_NC = ", ".join(f"'{c}'" for c in codes.NATION_CODES)
_RC = ", ".join(f"'{c}'" for c in codes.REGION_CONTINENT)
_TYPES = ", ".join(f"'{t}'" for t in codes.AIRCRAFT_TYPES)
_SEATS = ", ".join(f"'{s}'" for s in codes.SEAT_MAPS)


def _m(ts: str, n: str) -> str:
    return f"({ts} + to_minutes(cast({n} as bigint)))"


CTES: dict[str, tuple[str, list[str]]] = {}


def _def(name, sql, deps=()):
    CTES[name] = (sql, list(deps))


_def("f_n_airports", "select count(*) as n from supplier")
_def("f_n_passengers", "select count(*) as n from customer")

_def("f_nations", f"""
select n.n_nationkey, n.n_name, r.r_regionkey, r.r_name,
  case when n.n_nationkey < 8 then [{_NC}][n.n_nationkey + 1] else lpad(cast(n.n_nationkey as varchar), 2, '0') end as iso_country,
  coalesce([{_RC}][r.r_regionkey + 1], 'OC') as continent
from nation n join region r on n.n_regionkey = r.r_regionkey""")

_def("f_countries", """
select cast(n_nationkey as integer) as country_id, iso_country as code, n_name as name, continent,
  'https://en.wikipedia.org/wiki/' || n_name as wikipedia_link, cast(null as varchar) as keywords
from f_nations""", ["f_nations"])

_def("f_regions", """
select cast(n_nationkey as integer) as region_id,
  iso_country || '-' || lpad(cast(n_nationkey as varchar), 2, '0') as code,
  lpad(cast(n_nationkey as varchar), 2, '0') as local_code,
  n_name || ' ' || r_name as name, continent, iso_country,
  cast(null as varchar) as wikipedia_link, cast(null as varchar) as keywords
from f_nations""", ["f_nations"])

_k = "s.s_suppkey"
_def("f_airports", f"""
select {_k} as aeropuerto_id,
  lpad(cast({_k} as varchar), 4, '0') as ident,
  {PICK(['large_airport', 'medium_airport', 'small_airport'], _k, 'atype')} as type,
  s.s_name as nombre,
  cast({U(_k, 'lat')} * 170 - 85 as decimal(10,6)) as latitude_deg,
  cast({U(_k, 'lon')} * 360 - 180 as decimal(10,6)) as longitude_deg,
  cast(floor({U(_k, 'elev')} * 8000) as integer) as elevation_ft,
  n.continent, n.iso_country,
  n.iso_country || '-' || lpad(cast(n.n_nationkey as varchar), 2, '0') as iso_region,
  n.n_name as municipality,
  case when {U(_k, 'icao')} < 0.1 then null when {U(_k, 'icao')} < 0.2 then ''
       else lpad(cast({_k} as varchar), 4, '0') end as icao,
  case when {U(_k, 'iata')} < 0.4 then null
       else upper(substr(md5(lpad(cast({_k} as varchar), 4, '0')), 1, 3)) end as iata,
  case when {U(_k, 'cid')} < 0.5 then null else cast(n.n_nationkey as integer) end as country_id,
  case when {U(_k, 'rid')} < 0.5 then null else cast(n.n_nationkey as integer) end as region_id
from supplier s join f_nations n on s.s_nationkey = n.n_nationkey""", ["f_nations"])

_k = "aeronave_id"
_def("f_aircraft", f"""
select aeronave_id,
  'TI-' || lpad(cast(aeronave_id as varchar), 4, '0') as matricula,
  {PICK(codes.AIRCRAFT_TYPES, _k, 'tipo')} as tipo,
  {PICK(codes.SEAT_MAPS, _k, 'seats')} as configuracion_asientos,
  cast({U(_k, 'horas')} * 60000 + 500 as decimal(10,2)) as horas_vuelo,
  case when {U(_k, 'est')} < 0.85 then 'ACTIVO' when {U(_k, 'est')} < 0.95 then 'MANTENIMIENTO' else 'INACTIVO' end as estado,
  cast(date '2026-01-01' - cast(floor({U(_k, 'alta')} * 5000) as integer) as date) as fecha_alta
from (select distinct o_custkey % 100 as aeronave_id from orders)""")

_k = "o_orderkey"
_a = U(_k, "orig")
_b = U(_k, "dest")
_def("f_flights_base", f"""
select o_orderkey as vuelo_id,
  case when {U(_k, 'cs')} < 0.02 then null when {U(_k, 'cs')} < 0.04 then ''
       else [{_AL}][cast(floor({U(_k, 'airline')} * 15) as integer) + 1] || lpad(cast(o_orderkey % 10000 as varchar), 4, '0') end as numero_vuelo,
  cast(floor({U(_k, 'airline')} * 15) as bigint) + 1 as aerolinea_id,
  [{_AL}][cast(floor({U(_k, 'airline')} * 15) as integer) + 1] as codigo_aerolinea,
  o_custkey % 100 as aeronave_id,
  cast(floor(({_a})*({_a})*({_a})*({_a})*({_a})*({_a})*({_a})*({_a}) * (select n from f_n_airports)) as bigint) as origen_id,
  cast(floor(({_b})*({_b})*({_b})*({_b})*({_b})*({_b})*({_b})*({_b}) * (select n from f_n_airports)) as bigint) as d0,
  {_m('o_orderdate', f"floor({U(_k, 'dep')} * 1440)")} as dep_s,
  o_orderkey as _k, o_orderstatus
from orders""", ["f_n_airports"])

_k = "_k"
_arr = _m("dep_s", f"floor({U(_k, 'dur')} * 660) + 60")
_def("f_flights", f"""
select vuelo_id, numero_vuelo, aerolinea_id, codigo_aerolinea, aeronave_id, origen_id,
  case when d0 = origen_id then (d0 + 1) % (select n from f_n_airports) else d0 end as destino_id,
  dep_s as salida_programada,
  {_arr} as llegada_programada,
  case when {U(_k, 'rdn')} < 0.1 then null else {_m('dep_s', f"floor({U(_k, 'rdep')} * 180) - 20")} end as salida_real,
  case when {U(_k, 'ran')} < 0.3 then null else {_m(_arr, f"floor({U(_k, 'rarr')} * 60) - 15")} end as llegada_real,
  case when {U(_k, 'st')} < 0.03 then 'CANCEL' when {U(_k, 'st')} < 0.06 then 'DIVERTED'
       when o_orderstatus = 'O' then 'SCHED' when o_orderstatus = 'P' then 'ACTIVE' else 'LANDED' end as estado,
  case when {U(_k, 'mot')} < 0.05 then 'WEATHER' when {U(_k, 'mot')} < 0.08 then 'TECHNICAL' end as motivo_desviacion
from f_flights_base""", ["f_flights_base", "f_n_airports"])

_k = "c.c_custkey"
_def("f_passengers", f"""
select c.c_custkey as pasajero_id, replace(c.c_name, '#', ' ') as nombre,
  'DOC-' || cast(c.c_custkey as varchar) as documento, 'PASSPORT' as tipo_documento,
  n.iso_country as nacionalidad,
  case c.c_mktsegment when 'AUTOMOBILE' then 'FIRST' when 'BUILDING' then 'BUSINESS'
       when 'FURNITURE' then 'ECONOMY' when 'HOUSEHOLD' then 'GOLD' else 'SILVER' end as categoria,
  cast(date '2000-01-01' - cast(floor({U(_k, 'dob')} * 15000) as integer) as date) as fecha_nacimiento
from customer c join f_nations n on c.c_nationkey = n.n_nationkey""", ["f_nations"])

_k = "(l_orderkey * 8 + l_linenumber)"
_def("f_bookings", f"""
select l_orderkey * 8 + l_linenumber as pv_id, l_orderkey as vuelo_id,
  (l_partkey * 31 + l_suppkey) % (select n from f_n_passengers) as pasajero_id,
  case l_returnflag when 'A' then 'F' when 'R' then 'J' else 'Y' end as clase,
  cast(l_extendedprice as decimal(12,2)) as tarifa_usd,
  case when l_linestatus = 'F' then 'BOARDED' when {U(_k, 'bst')} < 0.6 then 'CONFIRMED'
       when {U(_k, 'bst')} < 0.9 then 'CHECKED' else 'NOSHOW' end as estado,
  lpad(cast(floor({U(_k, 'row')} * 40) + 1 as bigint)::varchar, 2, '0') || {PICK(list('ABCDEF'), _k, 'seat')} as asiento,
  cast(l_quantity as integer) % 4 as equipaje_piezas,
  cast(l_quantity as decimal(8,2)) as peso_equipaje_kg,
  l_shipdate as fecha_reserva
from lineitem""", ["f_n_passengers"])

_k = "(l.l_orderkey * 8 + l.l_linenumber)"
_def("f_cargo", f"""
select cast(l.l_orderkey as varchar) || '-' || cast(l.l_linenumber as varchar) as awb,
  l.l_orderkey as vuelo_id,
  case when p.p_type in ('ECONOMY', 'STANDARD') then 'GENERAL' when p.p_type = 'SMALL' then 'PERECIBLE'
       when p.p_type = 'MEDIUM' then 'PELIGROSA' when p.p_type = 'LARGE' then 'VALORADA'
       when p.p_type = 'PROMO' then 'ANIMALES' end as tipo_carga,
  cast(l.l_quantity * 20 as decimal(10,2)) as peso_kg,
  cast(l.l_quantity / 2 as decimal(10,2)) as volumen_m3,
  case when {U(_k, 'decl')} < 0.2 then null else
    json_object('commodity', p.p_name, 'customs_value_usd', cast(cast(l.l_extendedprice as decimal(12,2)) as double),
                'dangerous_goods', p.p_type = 'MEDIUM',
                'temperature_required', {PICK(['AMBIENT', '2-8C', '-18C'], 'l.l_orderkey', 'tmp')},
                'pieces', l.l_linenumber)::varchar end as declaracion_json,
  l.l_shipdate as fecha_carga
from lineitem l join part p on l.l_partkey = p.p_partkey""")

_k = "vuelo_id"
_lit = f"(cast({U(_k, 'lit')} * 85000 + 3000 as decimal(12,2)) * (case when {U(_k, 'litx')} < 0.02 then 4 else 1 end))"
_den = f"cast({U(_k, 'den')} * 0.06 + 0.78 as decimal(6,3))"
_pre = f"cast({U(_k, 'pre')} * 0.2 + 0.75 as decimal(8,4))"
_def("s_fuel_landed", """
select * from f_fuel where not coalesce(litros > 250000 or masa_kg > litros * 1.2, false)""", ["f_fuel"])

_def("f_fuel", f"""
select vuelo_id as fuel_id, vuelo_id, origen_id as aeropuerto_id,
  cast({_lit} as decimal(12,2)) as litros,
  {_den} as densidad_kgl,
  cast({_lit} * {_den} * (case when {U(_k, 'masx')} < 0.02 then 2 else 1 end) as decimal(14,3)) as masa_kg,
  {_pre} as precio_litro_usd,
  cast({_lit} * {_pre} as decimal(14,2)) as costo_total_usd,
  {_m('salida_programada', '-45')} as timestamp_carga
from f_flights where {U(_k, 'fuel')} >= 0.2""", ["f_flights"])

_k = "(l_orderkey * 8 + l_linenumber)"
_def("f_crew", f"""
select l_orderkey * 8 + l_linenumber as roster_id, l_orderkey as vuelo_id, l_suppkey as crew_id,
  ['CAPTAIN', 'FIRST_OFFICER', 'RELIEF_PILOT', 'PURSER', 'CABIN_CREW', 'LOADMASTER'][l_linenumber] as rol,
  {_m('l_shipdate', f"floor({U(_k, 'rep')} * 1440)")} as report_time,
  cast({U(_k, 'duty')} * 14 + 1 as decimal(5,2)) as duty_hours,
  cast({U(_k, 'rest')} * 4 + 10 - (case when l_suppkey % 3 = 0 and {U(_k, 'short')} < 0.05 then 4.5 else 0.0 end) as decimal(5,2)) as descanso_horas,
  10 as descanso_minimo
from lineitem""")

_k = "event_id"
_def("f_positions", f"""
select event_id as posicion_id, user_id as vuelo_id, ts as timestamp_utc,
  cast({U(_k, 'plat')} * 170 - 85 as decimal(9,6)) as latitud,
  cast({U(_k, 'plon')} * 360 - 180 as decimal(9,6)) as longitud,
  case when {U(_k, 'altn')} < 0.1 then null else cast({U(_k, 'alt')} * 40000 as decimal(8,2)) end as altitud_pies,
  value as velocidad_nudos,
  cast({U(_k, 'hdg')} * 360 as decimal(5,2)) as heading,
  cast({U(_k, 'dev')} * 60 as decimal(5,2)) as desviacion_nm,
  user_id % 75 as aerovia_id
from events""")


def _nul(expr, salt):
    return f"case when {U('event_id', salt)} < 0.05 then null else {expr} end"


_def("f_sensors", f"""
select event_id as sensor_id, 'ENG-' || lpad(cast(user_id % 50 as varchar), 2, '0') as engine_id,
  {_nul(f"cast({U(_k, 'n1')} * 95 + 20 as decimal(6,2))", 'n1n')} as n1_pct,
  {_nul(f"cast({U(_k, 'n2')} * 85 + 30 as decimal(6,2))", 'n2n')} as n2_pct,
  {_nul(f"cast({U(_k, 'egt')} * 500 + 350 + (case when (user_id % 50) % 10 = 0 then 350 else 0 end) as decimal(7,2))", 'egtn')} as egt_c,
  {_nul("cast(cast(value as decimal(12,2)) * 10 as decimal(10,2))", 'ffn')} as fuel_flow_kgh,
  {_nul("cast(cast(value as decimal(12,2)) * 0.05 + (case when (user_id % 50) % 10 = 1 then 5 else 0 end) as decimal(8,3))", 'vibn')} as vibration,
  ts as timestamp_utc
from events""")

_def("f_baggage", f"""
select event_id as baggage_id, 'BG' || lpad(cast(user_id as varchar), 4, '0') as tag_id, user_id as vuelo_id,
  lpad(cast(user_id % 100 as varchar), 4, '0') as aeropuerto,
  case when {U(_k, 'bev')} < 0.03 then null else
    case event_type when 'signup' then 'CHECKIN' when 'view' then 'LOAD' when 'click' then 'TRANSFER'
                    when 'purchase' then 'UNLOAD' when 'error' then 'LOST' end end as evento,
  ts as timestamp_utc
from events""")

_def("f_maintenance", f"""
select event_id as evento_id, user_id % 100 as aeronave_id,
  {PICK(['ENGINE', 'APU', 'LANDING_GEAR', 'AVIONICS', 'HYDRAULICS', 'FUEL_SYSTEM', 'CABIN', 'BRAKES'], _k, 'comp')} as componente,
  case when {U(_k, 'acn')} < 0.04 then null
       when event_type = 'view' then 'INSPECTION' when event_type = 'click' then 'CLEANING'
       when event_type = 'purchase' then 'REPAIR' when event_type = 'signup' then 'REPLACEMENT'
       when {U(_k, 'ovh')} < 0.5 then 'OVERHAUL' else 'TEST' end as accion,
  {PICK(['BOG', 'LAX', 'MAD', 'MIA', 'PTY', 'SJO', 'XXX'], _k, 'taller')} as taller_codigo,
  case when {U(_k, 'tecf')} < 0.1 then 'TECH-ABC' else 'TECH-' || lpad(cast(event_id % 1000 as varchar), 3, '0') end as tecnico_id,
  cast({U(_k, 'hrs')} * 60000 as decimal(10,2)) as horas_aeronave,
  ts as timestamp_utc,
  case when {U(_k, 'mst')} < 0.75 then 'CLOSED' when {U(_k, 'mst')} < 0.90 then 'INPROGRESS'
       when {U(_k, 'mst')} < 0.97 then 'OPEN' else 'DEFERRED' end as estado
from events""")

_k = "c.c_custkey"
_ok = "(c.c_custkey * 10)"
_code = f"[{_AL}][cast(floor({U(_ok, 'airline')} * 15) as integer) + 1]"
_pnr = f"case when {U(_k, 'pnrn')} < 0.05 then null else upper(substr(md5(cast({_k} as varchar)), 1, 6)) end"
_def("f_reservations", f"""
select c.c_custkey as reserva_id,
  {_pnr} as pnr,
  json_object('first_name', split_part(c.c_name, '#', 1), 'last_name', split_part(c.c_name, '#', 2),
              'document_type', case when {U(_k, 'dtn')} < 0.1 then null else 'PASSPORT' end,
              'nationality', case when {U(_k, 'natn')} < 0.05 then null else n.iso_country end,
              'frequent_flyer', {U(_k, 'ff')} < 0.2)::varchar as pasajero_json,
  json_object('flight_number', {_code} || lpad(cast({_ok} % 10000 as varchar), 4, '0'),
              'origin', lpad(cast({_ok} % 97 as varchar), 4, '0'),
              'destination', lpad(cast({_ok} % 89 as varchar), 4, '0'),
              'airline', {_code})::varchar as vuelos_json,
  case when {U(_k, 'clsn')} < 0.03 then null else {PICK(['F', 'C', 'W', 'Y', 'J'], _k, 'cls')} end as clase,
  case when {U(_k, 'farn')} < 0.06 then null else cast({U(_k, 'far')} * 1800 + 200 as decimal(10,2)) end as tarifa_usd,
  case when {U(_k, 'estn')} < 0.03 then null else {PICK(['CONFIRMED', 'CANCELLED', 'CHECKED', 'NOSHOW'], _k, 'est')} end as estado,
  {_m("timestamp '2024-01-01 00:00:00'", f"floor({U(_k, 'rts')} * 43200)")} as timestamp_utc
from customer c join f_nations n on c.c_nationkey = n.n_nationkey""", ["f_nations"])

_bid = "(c_custkey * 2 + seq)"
_def("f_boarding", f"""
select c_custkey * 2 + seq as boarding_id,
  {_pnr.replace('c.c_custkey', 'c_custkey')} as pnr,
  cast(c_custkey * 10 as varchar) as vuelo_id,
  case when {U(_bid, 'seatn')} < 0.05 then null else
    lpad(cast(floor({U(_bid, 'row')} * 40) + 1 as bigint)::varchar, 2, '0') || {PICK(list('ABCDEF'), _bid, 'seat')} end as asiento,
  'G' || cast(cast(floor({U(_bid, 'gate')} * 30) + 1 as bigint) as varchar) as gate,
  case when {U(_bid, 'tsn')} < 0.05 then null else
    {_m("timestamp '2024-01-01 00:00:00'", f"floor({U('c_custkey', 'rts')} * 43200) + 1440 + seq * 10")} end as timestamp_utc
from (select c_custkey, unnest(generate_series(0, case when {U('c_custkey', 'two')} < 0.2 then 1 else 0 end)) as seq
      from customer where {U('c_custkey', 'brd')} < 0.6)""")

_k = "p_partkey"
_def("f_navaids", f"""
select p_partkey as id, 'navaids_' || cast(p_partkey % 7 as varchar) || '.csv' as filename,
  substr(upper(replace(p_name, ' ', '')), 1, 10) as ident, p_name as name,
  {PICK(['VOR', 'VOR-DME', 'DME', 'NDB', 'NDB-DME', 'TACAN', 'INT', 'XYZ'], _k, 'ntype')} as type,
  cast(p_size as bigint) * 10 - 50 as frequency_khz,
  case when {U(_k, 'nlatn')} < 0.05 then null else cast({U(_k, 'nlat')} * 170 - 85 as decimal(12,8)) end as latitude_deg,
  cast({U(_k, 'nlon')} * 360 - 180 as decimal(12,8)) as longitude_deg,
  cast(floor({U(_k, 'nelev')} * 5000) as integer) as elevation_ft,
  p_brand as iso_country, p_type as iso_region,
  cast(p_size as bigint) * 3 - 20 as dme_frequency_khz,
  'CH' || cast(p_size as varchar) || 'XXXXXXXXXX' as dme_channel
from part""")

_lat1 = f"cast({U(_k, 'wlat')} * 120 - 60 as decimal(9,6))"
_lon1 = f"cast({U(_k, 'wlon')} * 340 - 170 as decimal(9,6))"
_def("f_airways", f"""
select p_partkey as aerovia_id,
  {PICK(['UL', 'UM', 'UN', 'UT', 'UA'], _k, 'wcode')} || cast(p_partkey as varchar) as codigo,
  {_lat1} as lat1, {_lon1} as lon1,
  cast({_lat1} + cast({U(_k, 'wdlat')} * 20 - 10 as decimal(9,6)) as decimal(9,6)) as lat2,
  cast({_lon1} + cast({U(_k, 'wdlon')} * 20 - 10 as decimal(9,6)) as decimal(9,6)) as lon2,
  cast(floor({U(_k, 'flmin')} * 200) + 50 as integer) as nivel_min,
  cast(floor({U(_k, 'flmax')} * 200) + 250 as integer) as nivel_max
from part""")

_desde = _m("timestamp '2024-01-01 00:00:00'", f"floor({U(_k, 'nd')} * 43200)")
_def("f_notams", f"""
select p_partkey as notam_id,
  {PICK(['A', 'B', 'C', 'D', 'E'], _k, 'nl')} || lpad(cast(p_partkey as varchar), 4, '0') || '/24' as ident,
  (p_partkey * 7) % (select n from f_n_airports) as aeropuerto_id,
  {PICK(['N', 'D', 'R', 'C'], _k, 'nt')} as tipo,
  cast(floor({U(_k, 'rad')} * 50) as integer) as radio_nm,
  cast(floor({U(_k, 'hmin')} * 5000) as integer) as altura_min,
  {_desde} as valido_desde,
  {_desde} + to_days(cast(floor({U(_k, 'nv')} * 30) + 1 as integer)) as valido_hasta
from part""", ["f_n_airports"])

_k = "event_id"
_def("f_airway_points", f"""
select punto_id, p.aerovia_id,
  cast(lat1 + f * (lat2 - lat1) + (jl * 0.6 - 0.3) as decimal(9,6)) as latitud,
  cast(lon1 + f * (lon2 - lon1) + (jo * 0.6 - 0.3) as decimal(9,6)) as longitud,
  altitud_pies
from (select event_id as punto_id, user_id % 75 as aerovia_id, {U(_k, 'frac')} as f,
             {U(_k, 'jlat')} as jl, {U(_k, 'jlon')} as jo,
             cast({U(_k, 'jalt')} * 45000 as decimal(8,2)) as altitud_pies from events) p
join f_airways w on p.aerovia_id = w.aerovia_id""", ["f_airways"])

_k = "(l_orderkey * 8 + l_linenumber)"
_def("f_rule_inputs", f"""
select l_orderkey * 8 + l_linenumber as registro_id, l_orderkey as vuelo_id,
  cast(l_quantity * 2.2 - 3 as decimal(8,2)) as load_factor_pct,
  cast(l_discount + 0.03 as decimal(8,4)) as efficiency_kg_km,
  cast({U(_k, 'var')} * 30 - 15 as decimal(8,2)) as variation_pct,
  cast({U(_k, 'saf')} * 108 - 4 as decimal(8,2)) as saf_pct,
  cast(l_extendedprice - 3000 as decimal(14,2)) as revenue_usd
from lineitem""")

_def("f_snapshot_old", f"select * from f_flights where {U('vuelo_id', 'snap_add')} >= 0.02", ["f_flights"])
_def("f_snapshot_new", f"""
select * replace (case when {U('vuelo_id', 'snap_upd')} < 0.05
                       then {PICK(['ACTIVE', 'LANDED', 'DIVERTED'], 'vuelo_id', 'snap_st')} else estado end as estado)
from f_flights where {U('vuelo_id', 'snap_del')} >= 0.02""", ["f_flights"])


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n):
        if n in seen:
            return
        for d in CTES[n][1]:
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_ctes(body: str, deps, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the fixture CTEs it needs plus query-local CTEs.

    ``extra`` is a list of (name, sql) pairs appended after the fixtures, in
    order, so later ones may refer to earlier ones.
    """
    parts = [f"{n} as ({CTES[n][0]})" for n in _order(deps)]
    for n, s in (extra or []):
        parts.append(f"{n} as ({s})")
    if not parts:
        return body
    return "with " + ",\n".join(parts) + "\n" + body
