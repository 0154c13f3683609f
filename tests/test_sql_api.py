"""The reference's functions called from Spark SQL agree with the set-based queries."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from contrail.plans.sql_api import register_sql_api
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def api(spark):
    register_sql_api(spark, SF_SMALL)
    return spark


def test_airport_distance_function_matches_query(api):
    q = {(r.aeropuerto_origen, r.aeropuerto_destino): (r.distancia_km, r.distancia_nm)
         for r in E.queries()["airport_distance"](api, SF_SMALL).collect()}
    (o, d), want = next(iter(q.items()))
    got = api.sql(f"SELECT * FROM fn_distancia_aeropuertos({o}, {d})").collect()
    assert len(got) == 1 and (got[0].distancia_km, got[0].distancia_nm) == want
    assert api.sql("SELECT * FROM fn_distancia_aeropuertos(-1, 0)").count() == 0   # unknown id: no row


def test_nearest_airport_function_matches_query(api):
    rows = E.queries()["nearest_airport"](api, SF_SMALL).orderBy("posicion_id").limit(5).collect()
    from contrail.sources.fixtures import Fixtures
    p = {r.posicion_id: (float(r.latitud), float(r.longitud)) for r in Fixtures(api, SF_SMALL).positions.collect()}
    for r in rows:
        la, lo = p[r.posicion_id]
        got = api.sql(f"SELECT * FROM fn_aeropuerto_mas_cercano({la}, {lo})").collect()
        assert len(got) == 1 and got[0].aeropuerto_id == r.aeropuerto_id and got[0].distancia_km == r.distancia_km


def test_single_point_functions_run(api):
    assert api.sql("SELECT fn_validar_coordenadas_globales(9.9939, -84.2088) AS v").first().v is True
    assert api.sql("SELECT fn_detectar_desviacion_ruta(9.9939, -84.2088, 1) AS d").first().d >= 0
    assert api.sql("SELECT * FROM fn_detectar_ingreso_notam(9.9939, -84.2088, 1)").count() == 1
    assert api.sql("SELECT * FROM fn_esta_en_aerovia(9.9939, -84.2088, 35000, 1)").count() == 1
    flight = api.table("combustible_carga").select("vuelo_id").first().vuelo_id
    eff = api.sql(f"SELECT * FROM fn_eficiencia_combustible({flight})").collect()
    assert len(eff) == 1 and eff[0].eficiencia_kg_km > 0


def test_named_views_are_queryable(api):
    from contrail.plans.sql_api import MATERIALIZED_VIEWS, VIEWS, register_views
    register_views(api, SF_SMALL)
    n = api.sql("SELECT sum(vuelos_totales) AS n FROM vw_puntualidad_vuelos").first().n
    assert n == E.queries()["fact_flight"](api, SF_SMALL).count()
    for v in list(VIEWS) + list(MATERIALIZED_VIEWS):
        assert api.table(v).columns
