"""Keyed deduplication (DISTINCT ON / ROW_NUMBER() = 1).

Implemented as a grouped ``min_by(payload, order_key)`` rather than a
window: the aggregate combines map-side, so a key that holds a third of
all rows is reduced to one row per input partition before the shuffle,
and no task ever buffers a whole group. The order key is a struct of
ascending-comparable parts built with the helpers below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.session import write_table

#: Repeated keys (or keys without parent) up to which only their own rows are moved.
FEW_KEYS = 100_000


def _c(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def asc(c, nulls_last: bool = False) -> list[Column]:
    c = _c(c)
    flag = c.isNull() if nulls_last else c.isNotNull()
    return [flag, c]


def desc(c, nulls_last: bool = True, kind: str = "num") -> list[Column]:
    """Descending part. ``kind``: num | ts | date | bool."""
    c = _c(c)
    if kind == "ts":
        v = -F.unix_micros(c.cast("timestamp"))
    elif kind == "date":
        v = -F.unix_date(c)
    elif kind == "bool":
        v = ~c
    else:
        v = -c
    flag = c.isNull() if nulls_last else c.isNotNull()
    return [flag, v]


def first_per_key(df: DataFrame, keys: list[str], order: list[Column],
                  payload: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the smallest ``order`` struct.

    ``order`` is a flat list of ascending-comparable Columns (use ``asc`` /
    ``desc``); add a unique column last for a total order.
    """
    payload = payload or [c for c in df.columns if c not in keys]
    # min over one struct (order parts first, then the whole payload): the
    # payload closes the order, so duplicate keys resolve the same way on
    # every run and engine (nulls first, as Spark orders structs), and a
    # single struct comparison is cheaper than min_by's pair of structs
    parts = [o.alias(f"_o{i}") for i, o in enumerate(order)] + [F.col(c).alias(f"_p_{c}") for c in payload]
    best = F.min(F.struct(*parts)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best._p_{c}").alias(c) for c in payload])


def one_per_seldom_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``first_per_key`` for keys that seldom repeat, such as those of a cleaned table.

    One pass counts hashes of the keys, so 8 bytes a row are shuffled; only rows whose hash
    comes again are compared, all others pass in place. Two keys with one hash are compared too
    and both stay. With many repeated keys the rows are grouped as in ``first_per_key``.
    """
    again = write_table(df.groupBy(F.xxhash64(*keys).alias("_again")).agg(F.count("*").alias("_n"))
                        .where("_n > 1").select("_again"), "again")
    n = again.count()  # one scalar, from the footers
    if n == 0:
        return df
    if n > FEW_KEYS:
        return first_per_key(df, keys, order).select(df.columns)
    hashed = df.withColumn("_again", F.xxhash64(*keys))
    some = hashed.join(F.broadcast(again), "_again", "left_semi").drop("_again")
    return (hashed.join(F.broadcast(again), "_again", "left_anti").drop("_again")
            .unionByName(first_per_key(some, keys, order).select(df.columns)))


def with_parent(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` is in ``parent`` (a semi-join), for tables where few are not.

    Only the keys are shuffled, to find those without a parent; their rows are then left out in
    place. With many of them the rows themselves are joined.
    """
    rows = df.where(F.col(key).isNotNull())
    lost = write_table(rows.select(key).distinct().join(parent.select(key), key, "left_anti"), "lost")
    n = lost.count()
    if n == 0:
        return rows
    return rows.join(parent.select(key), key, "left_semi") if n > FEW_KEYS else rows.join(F.broadcast(lost), key, "left_anti")
