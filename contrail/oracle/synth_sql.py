"""DuckDB oracle for the seeded generators."""

from __future__ import annotations

from contrail.functions import codes
from contrail.oracle.det_sql import PICK, U
from contrail.oracle.gold_sql import HAV
from contrail.plans.silver import INLINE_AIRCRAFT
from contrail.plans.synth_q import ADSB_AIRCRAFT_TYPES, ADSB_CALLSIGN_CODES, NOTAM_TEXTS

AL = [a[0] for a in codes.AIRLINES]
NAP = "(select count(*) from supplier)"


def NUL(k, salt, rate, expr):
    return f"(case when {U(k, salt)} < {rate} then null else {expr} end)"


def IDENT(idx):
    return f"lpad(cast(cast({idx} as bigint) as varchar), 4, '0')"


def _m(ts, n):
    return f"({ts} + to_minutes(cast({n} as bigint)))"


def register(oracle):
    k = "e.event_id"
    cs = NUL(k, "p1_csn", 0.15, f"{PICK(ADSB_CALLSIGN_CODES, k, 'p1_cs')} || cast(cast(floor({U(k, 'p1_csd')} * 9999) as bigint) as varchar)")
    src = (f"case when {U(k, 'p1_s1')} < 0.15 then 'OpenSky' when {U(k, 'p1_s2')} < 0.30 then 'FlightRadar24' "
           f"else 'ADS-B Exchange' end")
    jsrc = src.replace("p1_s1", "p1_j1").replace("p1_s2", "p1_j2")
    js = (f"'{{' || coalesce('\"callsign\":' || to_json({cs})::varchar || ',', '') || '\"source\":\"' || ({jsrc}) || '\",'"
          f" || '\"signal_strength_db\":' || cast(cast(-40 - {U(k, 'p1_sig')} * 35 as decimal(6,2)) as varchar)"
          f" || ',\"aircraft_type\":\"' || {PICK(ADSB_AIRCRAFT_TYPES, k, 'p1_at')} || '\",\"emergency\":'"
          f" || case when {U(k, 'p1_em')} < 0.01 then 'true' else 'false' end || '}}'")
    pt = f"{U(k, 'p1_ptn')} >= 0.05"
    oracle("synth_positions", f"""
select e.event_id as adsb_id,
  {NUL(k, 'p1_icn', 0.08, "upper(substr(md5(cast(e.event_id as varchar) || '|icao'), 1, 6))")} as icao24,
  cast(case when {pt} then cast(a.longitude_deg + ({U(k, 'p1_dx')} - 0.5) * 0.8 as decimal(10,6)) end as double) as lon,
  cast(case when {pt} then cast(a.latitude_deg + ({U(k, 'p1_dy')} - 0.5) * 0.8 as decimal(10,6)) end as double) as lat,
  cast({NUL(k, 'p1_altn', 0.10, f"cast(500 + {U(k, 'p1_alt')} * 39000 as decimal(10,2))")} as double) as altitud_pies,
  cast({NUL(k, 'p1_vn', 0.07, f"cast(120 + {U(k, 'p1_v')} * 420 as decimal(8,2))")} as double) as velocidad_nudos,
  cast({NUL(k, 'p1_hn', 0.06, f"cast({U(k, 'p1_h')} * 360 as decimal(5,2))")} as double) as heading,
  e.ts as timestamp_utc, {cs} as callsign, {js} as raw_json, {src} as fuente
from events e join f_airports a on a.aeropuerto_id = cast(floor({U(k, 'p1_ap')} * {NAP}) as bigint)""", ["f_airports"])

    k = "o_orderkey"
    uo, ud = U(k, "p2_o"), U(k, "p2_d")
    org = (f"case when {U(k, 'p2_o1')} < 0.03 then null when {U(k, 'p2_o2')} < 0.05 then '' "
           f"else {IDENT(f'floor({uo} * {NAP})')} end")
    dst = (f"case when {U(k, 'p2_d1')} < 0.03 then null when {U(k, 'p2_d2')} < 0.05 then '' "
           f"else {IDENT(f'floor({ud} * {NAP})')} end")
    rules = f"case when {U(k, 'p2_fr')} < 0.9 then 'IFR' else 'VFR' end"
    ftype = f"case when {U(k, 'p2_ft')} < 0.8 then 'S' else 'N' end"
    oracle("synth_flight_plans", f"""
select o_orderkey as plan_id,
  case when {U(k, 'p2_c1')} < 0.07 then null when {U(k, 'p2_c2')} < 0.11 then ''
       else {PICK(AL, k, 'p2_al')} || lpad(cast(o_orderkey % 10000 as varchar), 4, '0') end as callsign,
  {org} as origen_icao, {dst} as destino_icao,
  {PICK(['UL', 'UM', 'UN', 'UT', 'UA'], k, 'p2_aw')} || cast(cast(floor({U(k, 'p2_awn')} * 999) as bigint) as varchar) as aerovia,
  'FL' || cast(cast(floor({U(k, 'p2_fl')} * 200) + 250 as bigint) as varchar) as niveles,
  {_m('o_orderdate', f"floor({U(k, 'p2_eta')} * 1440)")} as eta,
  '<flight_plan><flight_rules>' || ({rules}) || '</flight_rules><flight_type>' || ({ftype}) || '</flight_type><origin>'
  || coalesce({org}, '') || '</origin><destination>' || coalesce({dst}, '') || '</destination><aircraft_type>'
  || {PICK(codes.AIRCRAFT_TYPES, k, 'p2_ac')} || '</aircraft_type></flight_plan>' as raw_xml
from orders""", [])

    oracle("synth_reservations", """
select reserva_id, pnr, clase, cast(tarifa_usd as double) as tarifa_usd, estado, timestamp_utc,
  json_extract_string(pasajero_json, '$.first_name') as first_name, json_extract_string(pasajero_json, '$.nationality') as nationality,
  json_extract_string(vuelos_json, '$.flight_number') as flight_number
from f_reservations""", ["f_reservations"])
    oracle("synth_boarding", "select * from f_boarding", ["f_boarding"])

    k = "(cast(reserva_id as varchar) || '|' || cast(bag_no as varchar))"
    oracle("synth_baggage", f"""
select reserva_id * 2 + bag_no as baggage_id, 'BG' || pnr || cast(bag_no as varchar) as tag_id, pnr,
  cast(reserva_id * 10 as varchar) as vuelo_id, {IDENT(f"floor({U(k, 'p5_ap')} * {NAP})")} as aeropuerto,
  {NUL(k, 'p5_evn', 0.04, PICK(['CHECKIN', 'LOAD', 'TRANSFER', 'UNLOAD', 'DELIVERED'], k, 'p5_ev'))} as evento,
  {_m('timestamp_utc', f"floor({U(k, 'p5_t')} * 2880)")} as timestamp_utc
from f_reservations, (select unnest([1, 2]) as bag_no) b where pnr is not null""", ["f_reservations"])

    k = "awb"
    oracle("synth_cargo", f"""
select awb, {NUL(k, 'p6_vn', 0.03, 'vuelo_id')} as vuelo_id, {NUL(k, 'p6_tn', 0.04, 'tipo_carga')} as tipo_carga,
  cast(peso_kg as double) as peso_kg, cast(volumen_m3 as double) as volumen_m3,
  {IDENT(f"floor({U(k, 'p6_o')} * {NAP})")} as origen, {IDENT(f"floor({U(k, 'p6_d')} * {NAP})")} as destino,
  declaracion_json is not null as con_declaracion
from f_cargo""", ["f_cargo"])

    k = "event_id"
    oracle("synth_sensors", f"""
select event_id as sensor_id, 'ENG-' || lpad(cast(user_id % 50 as varchar), 2, '0') as engine_id,
  cast({NUL(k, 'p7_n1n', 0.05, f"cast(20 + {U(k, 'p7_n1')} * 85 as decimal(6,2))")} as double) as n1_pct,
  cast({NUL(k, 'p7_n2n', 0.06, f"cast(30 + {U(k, 'p7_n2')} * 80 as decimal(6,2))")} as double) as n2_pct,
  cast({NUL(k, 'p7_egn', 0.07, f"cast(350 + {U(k, 'p7_eg')} * 450 as decimal(7,2))")} as double) as egt_c,
  cast({NUL(k, 'p7_ffn', 0.08, f"cast(800 + {U(k, 'p7_ff')} * 4200 as decimal(10,2))")} as double) as fuel_flow_kgh,
  cast({NUL(k, 'p7_vbn', 0.05, f"cast(0.1 + {U(k, 'p7_vb')} * 4.0 as decimal(6,3))")} as double) as vibration,
  ts as timestamp_utc
from events""", [])

    regs = [r[0] for r in INLINE_AIRCRAFT]
    comps = ["ENGINE", "APU", "LANDING_GEAR", "AVIONICS", "HYDRAULICS", "FUEL_SYSTEM", "CABIN", "BRAKES"]
    acts = ["INSPECTION", "CLEANING", "TEST", "REPAIR", "REPLACEMENT", "OVERHAUL"]
    oracle("synth_maintenance", f"""
select event_id as evento_id, {NUL(k, 'p8_an', 0.03, PICK(regs, k, 'p8_a'))} as aeronave_id,
  {NUL(k, 'p8_cn', 0.05, PICK(comps, k, 'p8_c'))} as componente,
  {NUL(k, 'p8_acn', 0.04, PICK(acts, k, 'p8_ac'))} as accion,
  {NUL(k, 'p8_tn', 0.06, "'MRO-' || " + PICK(['BOG', 'LAX', 'MAD', 'MIA', 'PTY', 'SJO'], k, 'p8_t'))} as taller_id,
  {NUL(k, 'p8_ten', 0.07, f"'TECH-' || lpad(cast(cast(floor({U(k, 'p8_te')} * 9999) as bigint) as varchar), 4, '0')")} as tecnico_id,
  cast({NUL(k, 'p8_hn', 0.05, f"cast({U(k, 'p8_h')} * 60000 as decimal(10,2))")} as double) as horas_aeronave,
  ts as timestamp_utc
from events""", [])

    k = "vuelo_id"
    lit = f"cast(3000 + {U(k, 'p9_l')} * 85000 as decimal(12,2))"
    oracle("synth_fuel", f"""
select vuelo_id as fuel_id, numero_vuelo as vuelo_id, {NUL(k, 'p9_apn', 0.04, IDENT('origen_id'))} as aeropuerto_icao,
  cast({NUL(k, 'p9_ln', 0.05, lit)} as double) as litros,
  cast({NUL(k, 'p9_dn', 0.04, f"cast(0.78 + {U(k, 'p9_d')} * 0.05 as decimal(5,3))")} as double) as densidad_kgl,
  cast({NUL(k, 'p9_pn', 0.06, f"cast({lit} * (0.75 + {U(k, 'p9_p')} * 0.20) as decimal(12,2))")} as double) as precio_usd,
  {_m('salida_programada', '-45')} as timestamp_utc
from f_flights""", ["f_flights"])

    k = ("(cast(l_orderkey as varchar) || '|' || cast(l_linenumber as varchar) || '|' || cast(l_partkey as varchar) "
         "|| '|' || cast(l_suppkey as varchar))")
    roles = ["CAPTAIN", "FIRST_OFFICER", "FO", "RELIEF_PILOT", "PURSER", "CABIN_CREW", "LOADMASTER"]
    oracle("synth_crew", f"""
select l_orderkey as orden, l_linenumber, l_partkey, l_suppkey,
  {NUL(k, 'p10_vn', 0.03, 'cast(l_orderkey as varchar)')} as vuelo_id,
  'CREW-' || lpad(cast(l_suppkey as varchar), 5, '0') as crew_id,
  {NUL(k, 'p10_rn', 0.04, PICK(roles, k, 'p10_r'))} as rol,
  {NUL(k, 'p10_tn', 0.05, _m('l_shipdate', f"floor({U(k, 'p10_t')} * 1440)"))} as report_time,
  cast({NUL(k, 'p10_dn', 0.06, f"cast(1 + {U(k, 'p10_d')} * 14 as decimal(5,2))")} as double) as duty_hours
from lineitem""", [])

    oracle("synth_airways", f"""
select aerovia_id, codigo as designador, cast(lat1 as double) as lat1, cast(lon1 as double) as lon1,
  cast(lat2 as double) as lat2, cast(lon2 as double) as lon2, nivel_min, nivel_max,
  round({HAV('lat1', 'lon1', 'lat2', 'lon2')} / 1000, 2) as longitud_km
from f_airways""", ["f_airways"])

    k = "notam_id"
    oracle("synth_notams", f"""
select notam_id, ident, aeropuerto_id, tipo,
  'REF-' || lpad(cast(cast(floor({U(k, 'j19_ref')} * 99999) as bigint) as varchar), 5, '0') || '/24' as referencia,
  radio_nm, altura_min, altura_min + cast(floor(1000 + {U(k, 'j19_h')} * 30000) as integer) as altura_max,
  valido_desde, valido_hasta, 'NOTAM ' || {PICK(NOTAM_TEXTS, k, 'j19_txt')} as raw_text
from f_notams""", ["f_notams"])
