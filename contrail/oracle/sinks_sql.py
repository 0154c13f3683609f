"""DuckDB oracle for sink round trips and streaming results."""

from __future__ import annotations

from contrail.oracle.det_sql import AVG_DEC


def register(oracle):
    oracle("append_sink", "select * from s_clean_flights", ["s_clean_flights"])
    oracle("insert_ignore", "select * from g_dim_calendar", ["g_dim_calendar"])
    oracle("partitioned_write_prune", """
select cast(tiempo_id / 100 as integer) as yyyymm, count(*) as vuelos, sum(pax_transportados) as pax,
  cast(round(sum(total_revenue_usd), 2) as double) as revenue
from g_fact_flight group by 1""", ["g_fact_flight"])
    def month_sums(fact, sums):
        return f"""(select t.mes, {sums} from {fact} h
  join g_dim_calendar t on t.tiempo_id = h.tiempo_id where t.anio = 1997 and t.trimestre = 2 group by t.mes)"""

    def total(c):
        return f"cast(sum(cast({c} as decimal(18,2))) as double)"
    oracle("fact_month_report", f"""
select v.mes, v.vuelos, v.pax, v.revenue, f.fuel_kg, c.cargo_kg, w.tripulantes
from {month_sums('g_fact_flight', f"count(*) as vuelos, sum(pax_transportados) as pax, {total('total_revenue_usd')} as revenue")} v
left join {month_sums('g_fact_fuel', f"{total('fuel_uplift_kg')} as fuel_kg")} f using (mes)
left join {month_sums('g_fact_cargo', f"{total('cargo_weight_kg')} as cargo_kg")} c using (mes)
left join {month_sums('g_fact_crew', "sum(crew_count) as tripulantes")} w using (mes)""",
           ["g_fact_flight", "g_fact_fuel", "g_fact_cargo", "g_fact_crew", "g_dim_calendar"])
    oracle("fact_month_reload", """
select case when tiempo_id between 19960101 and 19991231 then tiempo_id // 100 else 0 end as mes_id,
  count(*) as vuelos, sum(pax_transportados) as pax, sum(delay_min) as delay_min
from g_fact_flight where tiempo_id // 100 <> 199706 or delay_min > 15 group by 1""", ["g_fact_flight"])
    oracle("stream_latest_position", """
select vuelo_id, posicion_id, timestamp_utc, cast(latitud as double) as latitud, cast(longitud as double) as longitud,
  cast(altitud_pies as double) as altitud_pies, velocidad_nudos
from (select *, row_number() over (partition by vuelo_id order by timestamp_utc desc, posicion_id desc) as rn from f_positions)
where rn = 1""", ["f_positions"])
    oracle("stream_baggage_state", """
select b.tag_id, b.baggage_id, b.evento, b.timestamp_utc, c.eventos
from (select *, row_number() over (partition by tag_id order by timestamp_utc desc, baggage_id desc) as rn from f_baggage) b
join (select tag_id, count(*) as eventos from f_baggage group by tag_id) c on c.tag_id = b.tag_id
where rn = 1""", ["f_baggage"])
    oracle("stream_engine_health", f"""
select time_bucket(interval 1 hour, timestamp_utc) as ventana_inicio,
  time_bucket(interval 1 hour, timestamp_utc) + interval 1 hour as ventana_fin, engine_id, count(*) as lecturas,
  {AVG_DEC('egt_c', 2, 4)} as temperatura_promedio, {AVG_DEC('vibration', 3, 4)} as vibracion_promedio,
  case when avg(vibration) > 5 or avg(egt_c) > 900 then 'REQUIERE_INSPECCION' else 'OPERACION_NORMAL' end as estado_predictivo
from f_sensors
group by 1, 2, 3""",
           ["f_sensors"])
    oracle("stream_rule_quarantine", """
select registro_id, cast(load_factor_pct as double) as load_factor_pct,
  case when load_factor_pct < 0 or load_factor_pct > 100 then 'REJECTED' else 'ACCEPTED' end as resultado,
  case when load_factor_pct < 0 or load_factor_pct > 100 then 'M9' end as regla
from f_rule_inputs""", ["f_rule_inputs"])
