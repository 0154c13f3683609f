"""Query keys against the DuckDB oracle on the smallest scale factor."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
import tools.oracle_check as oc
from tools.oracle_check import compare

oc.EXACT = True  # floats compared bit for bit

# every key of the library itself, on the smallest scale factor; tests/llm has its own
KEYS = sorted(E._registry())


@pytest.fixture(scope="module")
def registry():
    return E.queries(), E.oracle_sql()


def test_every_query_has_an_oracle(registry):
    qs, sq = registry
    assert set(KEYS) <= set(qs) and set(KEYS) <= set(sq)
    assert len(KEYS) >= 130


def test_entry_returns_rows(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(df.columns) == {"anio", "mes", "vuelos_totales", "vuelos_puntuales", "otp_pct"}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, duck, registry, key):
    qs, sq = registry
    sdf = qs[key](spark, SF_SMALL)
    rows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(sq[key])
    dcols = [d[0] for d in res.description]
    assert compare(key, sdf.columns, rows, dcols, res.fetchall()) == "OK"
