"""DuckDB oracle for rules (M*) and audit (N*).

The maintenance-state rule (M4) is checked against a literal left fold
over the ordered events (``list_reduce``), an independent formulation of
the grouped reduction used on the Spark side.
"""

from __future__ import annotations

from contrail.oracle.det_sql import PICK, U

_TS = "strftime(salida_programada, '%Y-%m-%d %H:%M:%S')"


def _split(rows_sql: str, cols: str, rules: list[tuple[str, str]]) -> str:
    """resultado / regla columns: first rule that fires (NULL never fires)."""
    regla = "case " + " ".join(f"when coalesce({pred}, false) then '{rid}'" for rid, pred in rules) + " end"
    return (f"select {cols}, case when r is null then 'ACCEPTED' else 'REJECTED' end as resultado, r as regla "
            f"from (select *, {regla} as r from ({rows_sql}))")


def _counts(table: str, src: str, checks: list[tuple[str, str]]) -> str:
    return " union all ".join(
        f"select '{table}' as tabla, '{n}' as regla, cast(sum(case when coalesce(not ({c}), false) then 1 else 0 end) as bigint)"
        f" as violaciones, count(*) as filas from {src}" for n, c in checks)


def register(oracle):
    oracle("rule_airline_deactivation", _split(f"""
select al.aerolinea_id, al.codigo_icao, true as activa_old, {U('al.aerolinea_id', 'deact')} >= 0.3 as activa_new,
  coalesce(b.n, 0) as vuelos_activos
from s_airline_dim al left join (select aerolinea_id, count(*) as n from f_flights where estado in ('SCHED', 'ACTIVE')
                                  group by aerolinea_id) b on b.aerolinea_id = al.aerolinea_id""",
        "aerolinea_id, codigo_icao, activa_old, activa_new, vuelos_activos",
        [("M1", "activa_old and not activa_new and vuelos_activos > 0")]), ["s_airline_dim", "f_flights"])
    oracle("rule_aircraft_hours", """
select aeronave_id, cast(horas_vuelo as double) as horas_vuelo_totales, estado as estado_anterior,
  case when horas_vuelo >= 50000 and estado = 'ACTIVO' then 'MANTENIMIENTO' else estado end as estado,
  case when horas_vuelo >= 50000 and estado = 'ACTIVO' then 'MANTENIMIENTO_PREVENTIVO' end as alerta
from f_aircraft""", ["f_aircraft"])
    oracle("rule_flight_state", """
select vuelo_id, estado as estado_anterior, n as estado_nuevo, estado is distinct from n as cambio
from (select *, case when llegada_real is not null then 'LANDED' when salida_real is not null and estado = 'SCHED' then 'ACTIVE'
                     else estado end as n from f_flights)""", ["f_flights"])
    oracle("rule_maintenance_state", """
select a.aeronave_id, a.estado as estado_inicial,
  list_reduce(coalesce(e.effects, []), lambda acc, x: case when x = 'S' then 'MANTENIMIENTO' when x = 'DC' then 'ACTIVO'
                                                    when x = 'C' and acc = 'MANTENIMIENTO' then 'ACTIVO' else acc end,
              a.estado) as estado_final,
  coalesce(e.n, 0) as eventos_decisivos
from f_aircraft a left join (
  select aeronave_id,
    list(case when tipo_check = 'D' and estado = 'CLOSED' then 'DC'
              when tipo_check = 'D' or estado in ('OPEN', 'INPROGRESS') then 'S'
              when estado = 'CLOSED' then 'C' else 'N' end order by fecha_inicio, evento_id) as effects,
    count(*) filter (where tipo_check = 'D' or estado in ('OPEN', 'INPROGRESS', 'CLOSED')) as n
  from s_maintenance group by aeronave_id) e on e.aeronave_id = a.aeronave_id""", ["f_aircraft", "s_maintenance"])
    oracle("rule_crew_fatigue", _split("""
select roster_id, crew_id, vuelo_id, cast(duty_hours as double) as duty_hours, cast(descanso_horas as double) as descanso_horas,
  cast(descanso_minimo as double) as descanso_minimo_requerido, descanso_horas >= descanso_minimo as descanso_minimo_cumple
from f_crew""", "roster_id, crew_id, vuelo_id, duty_hours, descanso_horas, descanso_minimo_requerido, descanso_minimo_cumple",
        [("M5_DUTY", "duty_hours > 12"), ("M5_REST", "descanso_horas < descanso_minimo_requerido")]), ["f_crew"])
    oracle("rule_fuel", _split("""
select fuel_id, vuelo_id, litros, masa_kg, precio_litro_usd, cast(litros * precio_litro_usd as decimal(14,2)) as costo_total_usd
from f_fuel""", "fuel_id, vuelo_id, cast(litros as double) as litros, cast(masa_kg as double) as masa_kg, "
                "cast(precio_litro_usd as double) as precio_litro_usd, cast(costo_total_usd as double) as costo_total_usd",
        [("M6_LITROS", "litros > 250000"), ("M6_MASA", "masa_kg > litros * 1.2")]), ["f_fuel"])
    oracle("rule_revenue", _split("""
select registro_id, revenue_usd as passenger_revenue_usd,
  case when registro_id % 5 = 0 then null else saf_pct * 10 end as cargo_revenue_usd,
  coalesce(revenue_usd, 0) + coalesce(case when registro_id % 5 = 0 then null else saf_pct * 10 end, 0) as total_revenue_usd
from f_rule_inputs""", "registro_id, cast(passenger_revenue_usd as double) as passenger_revenue_usd, "
                       "cast(cargo_revenue_usd as double) as cargo_revenue_usd, cast(total_revenue_usd as double) as total_revenue_usd",
        [("M7", "total_revenue_usd < 0")]), ["f_rule_inputs"])
    oracle("rule_co2", """
select vuelo_id, cast(fuel_consumed_kg as double) as fuel_consumed_kg,
  cast(case when fuel_consumed_kg > 0 then round(fuel_consumed_kg * 3.16 / 1000, 2) else 0 end as double) as co2_emitted_ton
from g_fact_flight_raw""", ["g_fact_flight_raw"])
    oracle("rule_load_factor", _split("select registro_id, load_factor_pct from f_rule_inputs",
                                      "registro_id, cast(load_factor_pct as double) as load_factor_pct",
                                      [("M9", "load_factor_pct < 0 or load_factor_pct > 100")]), ["f_rule_inputs"])
    oracle("rule_fuel_efficiency", _split("select registro_id, efficiency_kg_km, variation_pct, saf_pct from f_rule_inputs",
                                          "registro_id, cast(efficiency_kg_km as double) as efficiency_kg_km, "
                                          "cast(variation_pct as double) as variation_pct, cast(saf_pct as double) as saf_pct",
                                          [("M10_SAF", "saf_pct < 0 or saf_pct > 100")]), ["f_rule_inputs"])
    oracle("alerts_union", """
select 'aeronaves' as tabla_origen, aeronave_id as registro_id, 'MANTENIMIENTO_PREVENTIVO' as alerta_id,
  'Aeronave enviada a mantenimiento por exceso de horas de vuelo' as mensaje, 'MEDIA' as severidad
from f_aircraft where horas_vuelo >= 50000 and estado = 'ACTIVO'
union all
select 'hechos_pasajero', registro_id, 'CAPACIDAD_OCIOSA', 'Load Factor bajo - revisar ruta', 'BAJA'
from f_rule_inputs where load_factor_pct < 50
union all
select 'hechos_pasajero', registro_id, 'ALERTA_OVERBOOKING', 'Load Factor muy alto - posible overbooking', 'MEDIA'
from f_rule_inputs where load_factor_pct > 95
union all
select 'hechos_combustible', registro_id, 'EFICIENCIA_ANOMALA', 'kg/km supera el rango realista', 'MEDIA'
from f_rule_inputs where efficiency_kg_km > 0.10
union all
select 'hechos_combustible', registro_id, 'VARIACION_CRITICA', 'Eficiencia vario mas de 10% vs plan', 'ALTA'
from f_rule_inputs where abs(variation_pct) > 10""", ["f_aircraft", "f_rule_inputs"])
    oracle("dq_check_domains", " union all ".join([
        _counts("vuelos", "f_flights", [("estado_dominio", "estado in ('SCHED', 'ACTIVE', 'LANDED', 'DIVERTED', 'CANCEL')"),
                                        ("motivo_dominio", "motivo_desviacion in ('WEATHER', 'TECHNICAL', 'ATC', 'CREW', 'GROUND')")]),
        _counts("tripulacion", "f_crew", [("rol_dominio", "rol in ('CAPTAIN', 'FO', 'RELIEF_CAPTAIN', 'PURSER', 'FA', 'LOADMASTER')")]),
        _counts("carga", "f_cargo", [("tipo_dominio", "tipo_carga in ('GENERAL', 'PERECIBLE', 'PELIGROSA', 'VALORADA', 'ANIMALES')")])]),
        ["f_flights", "f_crew", "f_cargo"])
    oracle("dq_check_ranges", " union all ".join([
        _counts("vuelos", "f_flights", [("llegada_despues_salida", "llegada_programada >= salida_programada"),
                                        ("llegada_real_despues_salida_real", "llegada_real >= salida_real")]),
        _counts("aerovias", "f_airways", [("nivel_max_mayor_min", "nivel_max >= nivel_min")]),
        _counts("notams", "f_notams", [("vigencia_ordenada", "valido_hasta >= valido_desde"),
                                       ("radio_rango", "radio_nm between 0 and 100")]),
        _counts("mantenimiento", "s_maintenance", [("fin_despues_inicio", "fecha_fin >= fecha_inicio")])]),
        ["f_flights", "f_airways", "f_notams", "s_maintenance"])
    cols = ["numero_vuelo", "aerolinea_id", "aeronave_id", "origen_id", "destino_id", "salida_programada",
            "llegada_programada", "salida_real", "llegada_real", "estado", "motivo_desviacion"]
    oracle("dq_not_null", _counts("vuelos", "f_flights", [(f"{c}_no_nulo", f"{c} is not null") for c in cols]), ["f_flights"])

    def dups(src, table, key):
        return (f"select '{table}' as tabla, '{key}' as clave, count(*) as claves_duplicadas, coalesce(sum(n), 0) as filas_duplicadas "
                f"from (select {key}, count(*) as n from {src} group by {key} having count(*) > 1)")
    oracle("dq_unique", " union all ".join([
        dups("f_flights", "vuelos", "vuelo_id"), dups("f_bookings", "pasajeros_vuelo", "pv_id"),
        dups("f_cargo", "carga_vuelo", "awb"), dups("f_navaids", "navaids", "ident"),
        dups("(select * from f_flights where length(numero_vuelo) > 0)", "vuelos", "numero_vuelo")]),
        ["f_flights", "f_bookings", "f_cargo", "f_navaids"])

    def orphans(child, table, fk, parent, pk):
        return (f"select '{table}' as tabla, '{fk}' as columna, count(*) as huerfanos from {child} c "
                f"where c.{fk} is not null and not exists (select 1 from {parent} p where p.{pk} = c.{fk})")
    oracle("dq_foreign_key", " union all ".join([
        orphans("f_bookings", "pasajeros_vuelo", "vuelo_id", "f_flights", "vuelo_id"),
        orphans("f_bookings", "pasajeros_vuelo", "pasajero_id", "f_passengers", "pasajero_id"),
        orphans("f_positions", "posicionamiento", "vuelo_id", "f_flights", "vuelo_id"),
        orphans("f_fuel", "combustible", "aeropuerto_id", "f_airports", "aeropuerto_id"),
        orphans("f_notams", "notams", "aeropuerto_id", "f_airports", "aeropuerto_id"),
        orphans("f_maintenance", "mantenimiento", "aeronave_id", "f_aircraft", "aeronave_id")]),
        ["f_bookings", "f_flights", "f_passengers", "f_positions", "f_fuel", "f_airports", "f_notams", "f_maintenance",
         "f_aircraft"])
    changes = """
select coalesce(o.vuelo_id, n.vuelo_id) as vuelo_id, o.estado as estado_anterior, n.estado as estado_nuevo,
  case when o.vuelo_id is null then 'INSERT' when n.vuelo_id is null then 'DELETE'
       when o.estado is distinct from n.estado then 'UPDATE' end as operacion
from f_snapshot_old o full outer join f_snapshot_new n on o.vuelo_id = n.vuelo_id"""
    oracle("audit_state_changes", "select * from q_changes where operacion is not null",
           ["f_snapshot_old", "f_snapshot_new"], extra=[("q_changes", changes)])
    snap = ("'{\"vuelo_id\":' || cast(n.vuelo_id as varchar) || ',\"numero_vuelo\":' || coalesce(to_json(n.numero_vuelo)::varchar, 'null')"
            " || ',\"estado\":' || coalesce(to_json(n.estado)::varchar, 'null')"
            " || ',\"salida_programada\":' || coalesce(to_json(strftime(n.salida_programada, '%Y-%m-%d %H:%M:%S'))::varchar, 'null')"
            " || ',\"origen_id\":' || coalesce(cast(n.origen_id as varchar), 'null')"
            " || ',\"destino_id\":' || coalesce(cast(n.destino_id as varchar), 'null') || '}'")
    hist = f"""
select c.vuelo_id, n.numero_vuelo, case when c.operacion = 'UPDATE' then c.estado_anterior end as estado_anterior,
  n.estado as estado_nuevo, c.operacion, {snap} as snapshot_completo, sha256({snap}) as hash_integridad
from q_changes c join f_snapshot_new n on n.vuelo_id = c.vuelo_id
where c.operacion in ('INSERT', 'UPDATE')"""
    oracle("audit_snapshot_hash", "select * from q_hist", ["f_snapshot_old", "f_snapshot_new"],
           extra=[("q_changes", changes), ("q_hist", hist)])
    oracle("audit_verify", f"""
select vuelo_id, operacion, hash_integridad from q_hist
where {U('vuelo_id', 'tamper')} < 0.2""", ["f_snapshot_old", "f_snapshot_new"],
           extra=[("q_changes", changes), ("q_hist", hist)])
    stored = f"""
select vuelo_id, 1 as version, 'INSERT' as operacion, {snap.replace('n.', 'o.')} as texto from f_snapshot_old o
union all
select c.vuelo_id, 2, c.operacion, case when c.operacion = 'DELETE' then {snap.replace('n.', 'o.')} else {snap} end
from q_changes c left join f_snapshot_old o on o.vuelo_id = c.vuelo_id left join f_snapshot_new n on n.vuelo_id = c.vuelo_id where c.operacion is not null"""
    chain = """
select s.vuelo_id, s.version, s.operacion, sha256(s.texto) as hash_integridad,
  case when s.version = 2 and b.vuelo_id is not null then sha256('|INSERT|' || sha256(b.texto)) else '' end as hash_previo
from q_stored s left join q_stored b on b.vuelo_id = s.vuelo_id and b.version = 1"""
    oracle("audit_history", "select *, sha256(hash_previo || '|' || operacion || '|' || hash_integridad) as hash_cadena from q_chain",
           ["f_snapshot_old", "f_snapshot_new"], extra=[("q_changes", changes), ("q_stored", stored), ("q_chain", chain)])
    oracle("audit_history_check", f"""
select vuelo_id, 2 as version, 'HASH' as falla from q_changes where operacion is not null and {U('vuelo_id', 'tamper')} < 0.2
union all
select null, 2, 'MANIFIESTO' where exists (select 1 from q_changes where operacion is not null and {U('vuelo_id', 'tamper')} < 0.2)""",
           ["f_snapshot_old", "f_snapshot_new"], extra=[("q_changes", changes)])
    oracle("route_registry", """
select origen_id, destino_id, row_number() over (order by not coalesce(early, false), origen_id, destino_id) as ruta_id
from (select origen_id, destino_id, bool_or(year(salida_programada) <= 1996) as early from f_flights
      where origen_id is not null and destino_id is not null group by 1, 2)""", ["f_flights"])
    oracle("audit_passenger_changes", f"""
select * from (
  select coalesce(o.pasajero_id, n.pasajero_id) as pasajero_id,
    case when o.pasajero_id is null then 'INSERT' when n.pasajero_id is null then 'DELETE'
         when o.nombre is distinct from n.nombre or o.nacionalidad is distinct from n.nacionalidad
              or o.categoria is distinct from n.categoria then 'UPDATE' end as operacion,
    o.nacionalidad as old_nacionalidad, n.nacionalidad as new_nacionalidad
  from (select * from f_passengers where {U('pasajero_id', 'pax_add')} >= 0.02) o
  full outer join (select * replace (case when {U('pasajero_id', 'pax_upd')} < 0.05 then 'XX' else nacionalidad end as nacionalidad)
                   from f_passengers where {U('pasajero_id', 'pax_del')} >= 0.02) n on o.pasajero_id = n.pasajero_id)
where operacion is not null""", ["f_passengers"])
