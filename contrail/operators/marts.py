"""Materialized views that are refreshed by changed months.

A ``MonthlyMart`` keeps sums and counts of a fact, one row per month and key, in one folder a month
(``MonthLayout``). Sums of integers and decimals can be added in any order, so the rows of all
months merge to what one pass over the whole fact gives. ``refresh`` looks at the fact's files only
(name, time of change, length), finds the months that differ from the state it stored last, reads
those months of the fact and replaces their rows.

The state is stored after the rows: a refresh that was cut short finds the same months changed and
does them again. Its inputs are the declared months, so what comes to the driver is bounded.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructType

from contrail.operators.months import MONTH, MonthLayout
from contrail.operators.versions import VersionedTable
from contrail.session import write_table


@dataclass(frozen=True)
class Measures:
    """What a mart keeps per month and key; ``rows`` joins or filters the fact's rows first."""

    keys: tuple[str, ...]
    sums: dict[str, str]
    counts: dict[str, str]
    rows: Callable[[DataFrame], DataFrame] = lambda df: df

    def partial(self, fact: DataFrame, date_key: str) -> DataFrame:
        out = (self.rows(fact).groupBy(MONTH, *self.keys)
               .agg(F.min(date_key).alias(date_key), *[F.sum(F.expr(e)).alias(n) for n, e in self.sums.items()],
                    *[F.count(F.expr(e)).alias(n) for n, e in self.counts.items()]))
        rounded = [n for n in self.sums if isinstance(out.schema[n].dataType, (DoubleType, FloatType))]
        if rounded:
            raise ValueError(f"sums of {rounded} depend on their order: cast to a decimal")
        return out

    def merge(self, partials: DataFrame, *keys: str | Column) -> DataFrame:
        """Sums and counts by any keys, e.g. attributes of a dimension joined to the stored rows."""
        return partials.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in (*self.sums, *self.counts)])


def mean(total: str, n: str, scale: int, out_scale: int) -> Column:
    """Average from a stored sum of ``scale`` digits and a count, rounded half up; null without values."""
    exact = F.col(total).cast(f"decimal(24,{scale})") / F.col(n).cast("decimal(13,0)")
    return F.round(F.when(F.col(n) > 0, exact).cast(f"decimal(22,{scale + 4})"), out_scale).cast("double")


class MonthlyMart:
    def __init__(self, spark: SparkSession, path: str, layout: MonthLayout, measures: Measures):
        self.spark, self.layout, self.measures = spark, layout, measures
        self.parts, self.state = f"{path}/parciales", VersionedTable(spark, f"{path}/estado")

    def fingerprints(self, fact_path: str) -> dict[int, tuple[int, int]]:
        """Number of files and a sum of their hashes for each month of the stored fact; no row is read."""
        files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
                 .load(fact_path).select(F.regexp_extract("path", f"/{MONTH}=([0-9]+)/", 1).cast("int").alias(MONTH),
                                         F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)").alias("h")))
        found = files.where(F.col(MONTH).isNotNull()).groupBy(MONTH).agg(F.count("*").alias("n"), F.sum("h").alias("h"))
        return {r[MONTH]: (r.n, int(r.h)) for r in found.collect()}  # one row a declared month

    def _last(self) -> tuple[int, dict[int, tuple[int, int]]]:
        numbers = self.state.numbers()
        if not numbers:
            return 0, {}
        rows = self.state.read().where(F.col("version") == numbers[-1]).collect()
        return numbers[-1], {r[MONTH]: (r.n, int(r.h)) for r in rows}

    def refresh(self, fact: DataFrame, fact_path: str) -> list[int]:
        """Bring the mart up to the fact stored at ``fact_path``; returns the months that were read again.

        ``fact`` is that table with its month column. The files are looked at before the rows are
        read: a reload in between is found by the next refresh.
        """
        version, before = self._last()
        now = self.fingerprints(fact_path)
        changed = sorted(m for m in before.keys() | now.keys() if before.get(m) != now.get(m))
        if changed:
            some = self.measures.partial(fact.where(F.col(MONTH).isin(changed)), self.layout.key)
            self.layout.reload(write_table(some.drop(MONTH), "mart-months"), self.parts, changed)
            state = self.spark.createDataFrame([(m, n, str(h)) for m, (n, h) in sorted(now.items())], f"{MONTH} int, n long, h string")
            self.state.commit(state, version + 1)
        return changed

    def read(self, fact: DataFrame) -> DataFrame:
        """The stored rows, one per month and key (``fact`` gives the types only)."""
        schema = StructType([f for f in self.measures.partial(fact, self.layout.key).schema.fields if f.name != MONTH])
        return self.layout.read(self.spark, self.parts, schema)
