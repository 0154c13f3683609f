"""Oracle SQL per query key (DuckDB dialect, driver views pre-registered)."""

from __future__ import annotations

from contrail.oracle import gold_sql, silver_sql  # noqa: F401  (register the CTEs of their layers)
from contrail.oracle.ctes import with_ctes
from contrail.oracle.det_sql import PCT_DEC

ORACLE: dict[str, str] = {}


def oracle(key: str, body: str, deps, extra=None):
    ORACLE[key] = with_ctes(body, deps, extra)


def _dbl_cols(cols: str) -> str:
    return cols


oracle("dim_calendar", "select * from g_dim_calendar", ["g_dim_calendar"])
oracle("dim_airport", """
select aeropuerto_id, icao, iata, nombre, ciudad, pais, region, zona_horaria, categoria,
  cast(latitud as double) as latitud, cast(longitud as double) as longitud from g_dim_airport""", ["g_dim_airport"])
oracle("dim_route", "select * from g_dim_route", ["g_dim_route"])
oracle("dim_aircraft", "select * from g_dim_aircraft", ["g_dim_aircraft"])
oracle("fact_flight", """
select * exclude (salida_programada) replace (
  cast(cargo_revenue_usd as double) as cargo_revenue_usd, cast(passenger_revenue_usd as double) as passenger_revenue_usd,
  cast(fuel_cost_usd as double) as fuel_cost_usd, cast(operating_cost_usd as double) as operating_cost_usd,
  cast(fuel_consumed_kg as double) as fuel_consumed_kg, cast(speed_avg_kts as double) as speed_avg_kts,
  cast(total_revenue_usd as double) as total_revenue_usd, cast(co2_emitted_ton as double) as co2_emitted_ton)
from g_fact_flight_raw""", ["g_fact_flight_raw"])
oracle("fact_flight_enrich", """
select vuelo_id, asientos_ofrecidos, asientos_vendidos, pax_transportados, pax_no_show,
  cast(passenger_revenue_usd as double) as passenger_revenue_usd, cast(total_revenue_usd as double) as total_revenue_usd
from g_fact_flight""", ["g_fact_flight"])
oracle("otp_by_month", f"""
select t.anio, t.mes, count(*) as vuelos_totales,
  sum(case when hv.delay_min <= 15 then 1 else 0 end) as vuelos_puntuales,
  {PCT_DEC('sum(case when hv.delay_min <= 15 then 1 else 0 end)', 'count(*)')} as otp_pct
from g_fact_flight hv join g_dim_calendar t on hv.tiempo_id = t.tiempo_id
group by t.anio, t.mes""", ["g_fact_flight", "g_dim_calendar"])
oracle("fact_flight_totals", f"""
select count(*) as total_vuelos, sum(asientos_ofrecidos) as total_asientos_ofrecidos, sum(pax_transportados) as total_pax,
  {PCT_DEC('sum(pax_transportados)', 'sum(asientos_ofrecidos)')} as load_factor_global,
  cast(round(sum(passenger_revenue_usd), 2) as double) as revenue_pax_total,
  cast(round(sum(cargo_revenue_usd), 2) as double) as revenue_cargo_total,
  cast(round(sum(total_revenue_usd), 2) as double) as revenue_total,
  cast(round(sum(co2_emitted_ton), 2) as double) as co2_total_ton,
  count(delay_code) as vuelos_con_delay
from g_fact_flight""", ["g_fact_flight"])


silver_sql.register(oracle)

from contrail.oracle import views_sql  # noqa: E402

views_sql.register(oracle)

from contrail.oracle import basics_sql  # noqa: E402

basics_sql.register(oracle)

from contrail.oracle import rules_sql  # noqa: E402

rules_sql.register(oracle)

from contrail.oracle import geo_sql  # noqa: E402

geo_sql.register(oracle)

from contrail.oracle import synth_sql  # noqa: E402

synth_sql.register(oracle)

from contrail.oracle import sinks_sql  # noqa: E402

sinks_sql.register(oracle)
ORACLE["mv_refresh"] = ORACLE["route_occupancy"]
ORACLE["mv_months_occupancy"] = ORACLE["route_occupancy"]
ORACLE["mv_months_otp"] = ORACLE["otp_by_airport"]
ORACLE["mv_months_fuel"] = ORACLE["fuel_efficiency_monthly"]
ORACLE["mv_months_cargo"] = ORACLE["cargo_demand_by_route"]
