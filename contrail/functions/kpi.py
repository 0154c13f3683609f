"""Airline KPIs (U8-U12) as Column expressions and Spark SQL functions.

Inputs are decimals so results round exactly (half up). Invalid inputs
either raise (``on_error="raise"``, the reference behaviour) or become
NULL (``on_error="null"``) so a batch job can quarantine the row instead
of failing. ``register_sql_functions`` also exposes them to SQL as
SQL-bodied temporary functions, which the analyzer inlines (no Python).
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _c(c, t: str) -> Column:
    return (c if isinstance(c, Column) else F.col(c)).cast(t)


def _guard(bad: Column, val: Column, msg: str, on_error: str) -> Column:
    bad = F.coalesce(bad, F.lit(False))
    if on_error == "raise":
        return F.when(bad, F.raise_error(F.lit(msg))).otherwise(val)
    return F.when(bad, F.lit(None)).otherwise(val)


def rpk(pax, km, on_error: str = "raise") -> Column:
    p, k = _c(pax, "decimal(18,0)"), _c(km, "decimal(12,2)")
    return _guard((p < 0) | (k < 0), F.round(p * k, 2), "RPK: valores negativos", on_error).cast("decimal(18,2)")


def ask(seats, km, on_error: str = "raise") -> Column:
    s, k = _c(seats, "decimal(18,0)"), _c(km, "decimal(12,2)")
    return _guard((s <= 0) | (k <= 0), F.round(s * k, 2), "ASK: valores no positivos", on_error).cast("decimal(18,2)")


def load_factor(pax, seats) -> Column:
    p, s = _c(pax, "decimal(18,0)"), _c(seats, "decimal(18,0)")
    lf = F.round(p * 100 / F.when(s != 0, s), 2)
    return (F.when(p.isNull() | s.isNull(), F.lit(None))
             .when(s == 0, F.lit(0))
             .otherwise(F.least(lf, F.lit(100)))).cast("decimal(5,2)")


def yield_usd(revenue, rpk_value, on_error: str = "raise") -> Column:
    r, k = _c(revenue, "decimal(18,2)"), _c(rpk_value, "decimal(18,2)")
    val = F.when(k.isNull() | (k == 0), F.lit(None)).otherwise(F.round(r / k, 4))
    return _guard(r < 0, val, "YIELD: revenue negativo", on_error).cast("decimal(12,4)")


def ctk(kg, km, on_error: str = "raise") -> Column:
    g, k = _c(kg, "decimal(18,2)"), _c(km, "decimal(12,2)")
    # kg * 0.001 keeps the product an exact decimal (no rounded division)
    tonnes = g * F.lit(0.001).cast("decimal(4,3)")
    return _guard((g < 0) | (k < 0), F.round(tonnes * k, 2), "CTK: valores negativos", on_error).cast("decimal(18,2)")


SQL_FUNCTIONS = {
    "fn_calcular_rpk": ("pax DECIMAL(18,0), km DECIMAL(12,2)", "DECIMAL(18,2)",
                        "CASE WHEN pax < 0 OR km < 0 THEN raise_error('RPK: valores negativos') "
                        "ELSE round(pax * km, 2) END"),
    "fn_calcular_ask": ("seats DECIMAL(18,0), km DECIMAL(12,2)", "DECIMAL(18,2)",
                        "CASE WHEN seats <= 0 OR km <= 0 THEN raise_error('ASK: valores no positivos') "
                        "ELSE round(seats * km, 2) END"),
    "fn_calcular_load_factor": ("pax DECIMAL(18,0), seats DECIMAL(18,0)", "DECIMAL(5,2)",
                                "CASE WHEN pax IS NULL OR seats IS NULL THEN NULL WHEN seats = 0 THEN 0 "
                                "ELSE least(round(pax * 100 / seats, 2), 100) END"),
    "fn_calcular_yield": ("revenue DECIMAL(18,2), rpk DECIMAL(18,2)", "DECIMAL(12,4)",
                          "CASE WHEN rpk IS NULL OR rpk = 0 THEN NULL WHEN revenue < 0 "
                          "THEN raise_error('YIELD: revenue negativo') ELSE round(revenue / rpk, 4) END"),
    "fn_calcular_ctk": ("kg DECIMAL(18,2), km DECIMAL(12,2)", "DECIMAL(18,2)",
                        "CASE WHEN kg < 0 OR km < 0 THEN raise_error('CTK: valores negativos') "
                        "ELSE round(kg * 0.001 * km, 2) END"),
    "fn_validar_coordenadas_globales": ("lat DOUBLE, lon DOUBLE", "BOOLEAN",
                                        "lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180"),
}


def register_sql_functions(spark: SparkSession) -> None:
    for name, (args, ret, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
