"""Facts kept as one folder a month, with a default partition.

``MonthLayout`` is the declared layout of a fact: the months it has partitions for and the date key
(YYYYMMDD) they follow. A row whose date is null or outside those months goes to the default
partition, ``mes_id`` 0, so a load never fails on a date and never loses a row.

* ``write``  -- the whole table, one folder a month.
* ``reload`` -- some months again: only their folders are replaced, so a rerun never doubles a fact
  and a month that has no rows any more becomes empty. Folders are replaced one by one; a reload
  that was cut short is made good by repeating it.
* ``on_calendar`` -- join with a (filtered) calendar on the date and on the month, so that Spark
  prunes the fact's folders by the months that the calendar's filter leaves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

MONTH = "mes_id"
DEFAULT = 0


@dataclass(frozen=True)
class MonthLayout:
    first: int
    last: int
    key: str = "tiempo_id"

    def month(self) -> Column:
        """The partition of a row: YYYYMM of its date key, or the default partition."""
        m = F.floor(F.col(self.key) / 100).cast("int")
        return F.when(m.between(self.first, self.last), m).otherwise(F.lit(DEFAULT))

    def with_month(self, df: DataFrame) -> DataFrame:
        if MONTH in df.columns:
            raise ValueError(f"the table has a column named {MONTH} of its own")
        return df.withColumn(MONTH, self.month())

    def _put(self, df: DataFrame, path: str) -> None:
        # rebalanced by month: a large month is split over several writers, small ones stay whole
        (df.hint("rebalance", MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .option("compression", "zstd").partitionBy(MONTH).parquet(path))

    def write(self, df: DataFrame, path: str) -> DataFrame:
        """Write the whole table to a new folder and return it, ``mes_id`` included."""
        self._put(self.with_month(df), path)
        return self.read(df.sparkSession, path, df.schema)

    def read(self, spark: SparkSession, path: str, schema: StructType) -> DataFrame:
        # the declared schema: a table without rows has no folder that would tell it
        return spark.read.schema(StructType([*schema.fields, StructField(MONTH, IntegerType())])).parquet(path)

    def reload(self, df: DataFrame, path: str, months: list[int]) -> DataFrame:
        """Replace the partitions ``months`` by the rows of ``df`` that belong to them.

        Rows of ``df`` in other months are left out: their partitions stay as they are.
        """
        wrong = [m for m in months if m != DEFAULT and not self.first <= m <= self.last]
        if wrong:
            raise ValueError(f"no partitions for months {wrong}: they are in the default partition, {DEFAULT}")
        rows = self.with_month(df).where(F.col(MONTH).isin(months))
        there = {r[0] for r in rows.select(MONTH).distinct().collect()}  # at most the months named
        for month in sorted(set(months) - there):
            rows.drop(MONTH).limit(0).write.mode("overwrite").parquet(f"{path}/{MONTH}={month}")
        if there:
            self._put(rows, path)
        df.sparkSession.catalog.refreshByPath(path)
        return self.read(df.sparkSession, path, df.schema)

    def on_calendar(self, fact: DataFrame, calendar: DataFrame) -> DataFrame:
        """``fact`` (with ``mes_id``) joined with the days of ``calendar``; undated rows match no day."""
        return fact.join(self.with_month(calendar), [self.key, MONTH]).drop(MONTH)
