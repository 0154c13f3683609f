"""Column-level helpers shared by the pipelines: code maps, banding,
time arithmetic, JSON and text cleaning. All return Column expressions,
so they stay inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def code_map(c, pairs: Sequence[tuple], default=None) -> Column:
    """Simple CASE: value -> mapped value, else ``default`` (NULL falls to default)."""
    m = F.create_map(*[x for kv in pairs for x in (F.lit(kv[0]), F.lit(kv[1]))])
    out = F.try_element_at(m, col(c))
    return out if default is None else F.coalesce(out, F.lit(default))


def blank_to_null(c) -> Column:
    """NULLIF(TRIM(x), '')."""
    t = F.trim(col(c))
    return F.when(t == "", F.lit(None)).otherwise(t)


def not_blank(c) -> Column:
    return col(c).isNotNull() & (F.trim(col(c)) != "")


def minutes_between(later, earlier) -> Column:
    """EXTRACT(EPOCH FROM later - earlier) / 60 as double."""
    return (F.unix_micros(col(later).cast("timestamp")) - F.unix_micros(col(earlier).cast("timestamp"))) / 6e7


def round_int(c) -> Column:
    """``::int`` of the reference: rounds (Spark's cast truncates, trap T1)."""
    return F.round(col(c)).cast("int")


def plus_hours(ts, hours) -> Column:
    """ts + (hours || ' hours')::interval, fractional hours kept to the second."""
    secs = (col(hours).cast("double") * 3600).cast("decimal(18,6)")
    return col(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def add_minutes(ts, n) -> Column:
    return F.timestamp_add("MINUTE", col(n).cast("bigint"), col(ts))


def date_key(ts) -> Column:
    """TO_CHAR(ts, 'YYYYMMDD')::int."""
    return F.date_format(col(ts), "yyyyMMdd").cast("int")


def month_key(ts) -> Column:
    return F.date_format(col(ts), "yyyyMM").cast("int")


def json_sum_values(js) -> Column:
    """Sum of the integer values of a flat JSON object (jsonb_each_text + SUM)."""
    m = F.from_json(col(js), "map<string,int>")
    return F.aggregate(F.map_values(m), F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))


def flight_phase(alt_ft, speed_kts) -> Column:
    """Phase banding of a position; first matching rule wins (trap T8).

    Null altitude counts as 0 ft, as in the reference.
    """
    a = F.coalesce(col(alt_ft).cast("double"), F.lit(0.0))
    v = col(speed_kts).cast("double")
    return (F.when((a < 1000) & (v < 50), "TAXI")
             .when((a < 1500) & (v >= 50), "TAKEOFF")
             .when(a.between(1500, 18000) & (v >= 200), "CLIMB")
             .when(a > 28000, "CRUISE")
             .when(a.between(10000, 28000), "DESCENT")
             .when(a.between(3000, 10000), "APPROACH")
             .otherwise("LANDING"))


def money(c, scale: int = 2) -> Column:
    """Round to ``scale`` (half up) and return a double for reporting."""
    return F.round(col(c), scale).cast("double")


def avg_dec(c, scale: int, out_scale: int) -> Column:
    """AVG over exact decimals of ``scale`` digits, rounded half-up to ``out_scale``.

    Averaging already-rounded doubles makes exact ties common; decimal
    input keeps the rounding deterministic on every engine.
    """
    return F.round(F.avg(col(c).cast(f"decimal(18,{scale})")), out_scale).cast("double")
