"""Sink and streaming queries (A9, A10, A14, A15, ST1-ST4).

Each query writes through the sink under test into a fresh folder of the
shared checkpoint directory and returns the table read back, so the
check covers the round trip.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.operators import sinks
from contrail.operators.months import MONTH, MonthLayout
from contrail.plans import silver as _s
from contrail.plans.context import FACT_MONTHS, Layers
from contrail.plans.queries import REGISTRY, _dbl, query
from contrail.session import scratch_path
from contrail.streaming import stream


def _path(L: Layers, name: str) -> str:
    return scratch_path(L.spark, f"warehouse/{name}-{uuid.uuid4().hex}")


@query
def append_sink(L: Layers) -> DataFrame:
    """The flight load appended in two disjoint batches (by status) and read back."""
    path = _path(L, "vuelos")
    f = _s.clean_flights(L.fx.flights, L.fx.airports, L.airlines)
    sinks.append(f.where(F.col("estado").isin("SCHED", "ACTIVE")), path)
    sinks.append(f.where(~F.col("estado").isin("SCHED", "ACTIVE")), path)
    return L.spark.read.parquet(path)


@query
def insert_ignore(L: Layers) -> DataFrame:
    """A10: two overlapping calendar loads; ON CONFLICT DO NOTHING keeps one row per day."""
    path = _path(L, "dim_tiempo")
    cal = L.dim_calendar
    sinks.insert_ignore(L.spark, cal.where(F.col("anio") <= 1998), path, ["tiempo_id"])
    sinks.insert_ignore(L.spark, cal, path, ["tiempo_id"])
    return L.spark.read.parquet(path)


@query
def partitioned_write_prune(L: Layers) -> DataFrame:
    """Facts written by month with dynamic overwrite, twice (idempotent), read back per month."""
    path = _path(L, "hechos_vuelo")
    fact = L.fact_flight.select("vuelo_id", "tiempo_id", "pax_transportados", "total_revenue_usd") \
                        .withColumn("yyyymm", sinks.month_key())
    sinks.write_partitioned(fact, path)
    sinks.write_partitioned(fact, path)
    back = L.spark.read.parquet(path)
    return back.groupBy("yyyymm").agg(F.count("*").alias("vuelos"), F.sum("pax_transportados").alias("pax"),
                                      F.round(F.sum("total_revenue_usd"), 2).cast("double").alias("revenue"))


@query
def fact_month_report(L: Layers) -> DataFrame:
    """A14 read: flights, fuel, cargo and crew of the months of one quarter; only their partitions are read."""
    days = L.dim_calendar.where((F.col("anio") == 1997) & (F.col("trimestre") == 2)).select("tiempo_id", "mes")

    def by_month(fact: str, **sums) -> DataFrame:
        rows = FACT_MONTHS.on_calendar(L.months(fact), days)
        return rows.groupBy("mes").agg(*[c.alias(n) for n, c in sums.items()])

    def total(c: str):
        return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
    flights = by_month("fact_flight", vuelos=F.count("*"), pax=F.sum("pax_transportados"), revenue=total("total_revenue_usd"))
    fuel = by_month("fact_fuel", fuel_kg=total("fuel_uplift_kg"))
    cargo = by_month("fact_cargo", cargo_kg=total("cargo_weight_kg"))
    crew = by_month("fact_crew", tripulantes=F.sum("crew_count"))
    return flights.join(fuel, "mes", "left").join(cargo, "mes", "left").join(crew, "mes", "left")


@query
def fact_month_reload(L: Layers) -> DataFrame:
    """One month of the flight fact loaded again from corrected rows, twice; dates without a partition in the default one."""
    path, layout = _path(L, "hechos_vuelo_mes"), MonthLayout(199601, 199912)
    fact = L.fact_flight.select("vuelo_id", "tiempo_id", "pax_transportados", "delay_min")
    layout.write(fact, path)
    late = fact.where("delay_min > 15")
    layout.reload(late, path, [199706])
    back = layout.reload(late, path, [199706])
    return back.groupBy(MONTH).agg(F.count("*").alias("vuelos"), F.sum("pax_transportados").alias("pax"),
                                   F.sum("delay_min").alias("delay_min"))


@query
def mv_refresh(L: Layers) -> DataFrame:
    """Route occupancy materialized, refreshed, and served from Parquet."""
    path = _path(L, "mv_ocupacion_por_ruta")
    sinks.refresh_mv(REGISTRY["route_occupancy"](L), path)
    return sinks.refresh_mv(REGISTRY["route_occupancy"](L), path)


@query
def stream_latest_position(L: Layers) -> DataFrame:
    return _dbl(stream.latest_position_stream(L.spark, L.fx.sf_dir))


@query
def stream_baggage_state(L: Layers) -> DataFrame:
    return stream.baggage_state_stream(L.spark, L.fx.sf_dir)


@query
def stream_engine_health(L: Layers) -> DataFrame:
    return stream.engine_health_stream(L.spark, L.fx.sf_dir)


@query
def stream_rule_quarantine(L: Layers) -> DataFrame:
    return _dbl(stream.rule_quarantine_stream(L.spark, L.fx.sf_dir))
