"""Deterministic pseudo-random columns.

The reference draws ``random()`` independently at every call site. A
distributed job needs the same value on every retry of a task, so every
draw here is a pure function of (row key, salt):

    u(key, salt) = int(md5(key || '|' || salt)[0:8], 16) / 2**32   in [0, 1)

One fresh salt per call site keeps chained CASE odds identical to the
reference (trap T3). The expression is JVM-side (md5 + conv), so it stays
inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296.0


def _col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def u(key, salt: str) -> Column:
    """Uniform double in [0, 1) from a key column and a salt string."""
    k = _col(key).cast("string")
    h = F.substring(F.md5(F.concat(k, F.lit("|" + salt))), 1, 8)
    return F.conv(h, 16, 10).cast("bigint") / F.lit(_TWO_32)


def pick(values: Sequence, key, salt: str) -> Column:
    """Uniform choice from a literal list, keyed by (key, salt)."""
    n = len(values)
    idx = F.floor(u(key, salt) * n).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx)


def pick_index(n: int, key, salt: str) -> Column:
    """Uniform 0-based index in [0, n)."""
    return F.floor(u(key, salt) * n).cast("bigint")


def between_draw(lo: float, span: float, key, salt: str) -> Column:
    """lo + span * u(key, salt)."""
    return F.lit(lo) + F.lit(span) * u(key, salt)


def hash_order(key, salt: str) -> Column:
    """Sort key that replaces ``ORDER BY random()``."""
    return F.md5(F.concat(_col(key).cast("string"), F.lit("|" + salt)))
