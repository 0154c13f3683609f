"""Row rules re-aimed from BEFORE-row triggers and CHECK constraints.

``apply_rules(df, rejects, alerts)`` evaluates every rule in one narrow
projection and returns three DataFrames:

* accepted -- rows no reject rule fired on;
* rejected -- rows with the id and message of the *first* rule that fired
  (the reference raises on the first failing check);
* alerts   -- one row per (row, alert) that fired (the reference's NOTICEs).

A rule predicate that evaluates to NULL does not fire, like an IF in
PL/pgSQL and a CHECK constraint in SQL (trap T18).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Rule:
    rule_id: str
    fires: Column
    message: str
    severity: str = "ALTA"


def apply_rules(df: DataFrame, rejects: list[Rule], alerts: list[Rule] | None = None,
                key: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    alerts = alerts or []
    first = F.lit(None).cast("string")
    msg = F.lit(None).cast("string")
    for r in reversed(rejects):
        first = F.when(F.coalesce(r.fires, F.lit(False)), F.lit(r.rule_id)).otherwise(first)
        msg = F.when(F.coalesce(r.fires, F.lit(False)), F.lit(r.message)).otherwise(msg)
    fired = F.filter(F.array(*[
        F.when(F.coalesce(a.fires, F.lit(False)),
               F.struct(F.lit(a.rule_id).alias("alerta_id"), F.lit(a.message).alias("mensaje"),
                        F.lit(a.severity).alias("severidad")))
        for a in alerts]) if alerts else F.array().cast("array<struct<alerta_id:string,mensaje:string,severidad:string>>"),
        lambda x: x.isNotNull())
    tagged = df.withColumn("_regla", first).withColumn("_mensaje", msg).withColumn("_alertas", fired)
    accepted = tagged.where(F.col("_regla").isNull()).drop("_regla", "_mensaje", "_alertas")
    rejected = (tagged.where(F.col("_regla").isNotNull())
                .withColumnRenamed("_regla", "regla").withColumnRenamed("_mensaje", "mensaje").drop("_alertas"))
    keys = key or df.columns
    alert_rows = (tagged.select(*keys, F.explode("_alertas").alias("a"))
                  .select(*keys, "a.alerta_id", "a.mensaje", "a.severidad"))
    return accepted, rejected, alert_rows


def split_report(df: DataFrame, rejects: list[Rule], alerts: list[Rule] | None = None,
                 key: list[str] | None = None) -> DataFrame:
    """accepted + rejected as one frame with ``resultado`` and ``regla`` columns."""
    acc, rej, _ = apply_rules(df, rejects, alerts, key)
    return (acc.withColumn("resultado", F.lit("ACCEPTED")).withColumn("regla", F.lit(None).cast("string"))
               .unionByName(rej.drop("mensaje").withColumn("resultado", F.lit("REJECTED"))))


def expectation_counts(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """Violations per named check, SQL-CHECK style (NULL passes). One pass over ``df``."""
    aggs = [F.sum(F.when(F.coalesce(~c, F.lit(False)), 1).otherwise(0)).alias(n) for n, c in checks.items()]
    wide = df.agg(F.count("*").alias("_filas"), *aggs)
    stack = ", ".join(f"'{n}', `{n}`" for n in checks)
    return wide.selectExpr(f"stack({len(checks)}, {stack}) as (regla, violaciones)", "_filas as filas") \
               .select(F.lit(table).alias("tabla"), "regla", F.col("violaciones").cast("bigint"), "filas")


def code_lengths(limits: dict[str, int]) -> dict[str, Column]:
    """Checks that codes are at most so many characters long without surrounding spaces; null passes."""
    return {c: F.char_length(F.trim(c)) <= n for c, n in limits.items()}
