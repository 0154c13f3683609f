"""SQL-text twins of the deterministic draws, for the DuckDB oracle."""

from __future__ import annotations


def U(key: str, salt: str) -> str:
    """u(key, salt) as DuckDB SQL (same md5 prefix / 2**32 as the Spark side)."""
    return (f"(cast(('0x' || substr(md5(cast({key} as varchar) || '|{salt}'), 1, 8)) as bigint)"
            f" / 4294967296.0)")


def PICK(values, key: str, salt: str) -> str:
    lits = ", ".join(_lit(v) for v in values)
    return f"([{lits}][cast(floor({U(key, salt)} * {len(values)}) as integer) + 1])"


def PICK_INDEX(n: int, key: str, salt: str) -> str:
    return f"cast(floor({U(key, salt)} * {n}) as bigint)"


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def AVG_DEC(col: str, scale: int, out_scale: int) -> str:
    """Spark's AVG(decimal(18,scale)) then ROUND(out_scale), in exact integer arithmetic.

    Spark returns the average at scale+4 (half up), then rounds half up to
    out_scale; both steps are emulated with hugeint division.
    """
    s, k = scale, out_scale
    n = f"count({col})"
    a = f"cast(sum(cast({col} as decimal(18,{s}))) * {10 ** s} as hugeint) * 10000"
    q1 = f"(sign({a}) * ((2 * abs({a}) + {n}) // (2 * {n})))"
    d = 10 ** (s + 4 - k)
    q2 = f"(sign({q1}) * ((2 * abs({q1}) + {d}) // (2 * {d})))"
    return f"(case when {n} = 0 then null else cast({q2} as double) / {10 ** k} end)"


def DIV_DEC(a: str, b: str, sa: int, sb: int, mid: int, out: int) -> str:
    """Spark's decimal a / b then ROUND(out), exactly.

    Spark divides decimals half-up at the result type's scale ``mid`` (e.g.
    6 for decimal(38,6)), then ROUND rounds half-up again; DuckDB would
    divide in double. Both steps are redone in hugeint arithmetic.
    """
    ai = f"cast(({a}) * {10 ** sa} as hugeint)"
    bi = f"cast(({b}) * {10 ** sb} as hugeint)"
    num = f"({ai} * {10 ** (sb - sa + mid)})"
    q1 = f"(sign({num}) * sign({bi}) * ((2 * abs({num}) + abs({bi})) // (2 * abs({bi}))))"
    d = 10 ** (mid - out)
    q2 = f"(sign({q1}) * ((2 * abs({q1}) + {d}) // (2 * {d})))"
    return f"(case when {bi} = 0 then null else cast({q2} as double) / {10 ** out} end)"


def _half_up(num: str, den: str) -> str:
    return f"(sign({num}) * sign({den}) * ((2 * abs({num}) + abs({den})) // (2 * abs({den}))))"


def PCT_DEC(num: str, den: str) -> str:
    """Spark's ROUND(CAST(num AS DECIMAL(20,6)) / den * 100, 2) for integer num, den.

    The quotient is decimal(38,24) (half up), times 100 is decimal(38,20)
    (half up), then ROUND 2 (half up) -- redone in hugeint arithmetic.
    """
    n, d = f"cast({num} as hugeint)", f"cast({den} as hugeint)"
    q1 = _half_up(f"({n} * {10 ** 24})", d)
    q2 = _half_up(f"({q1} * 100)", str(10 ** 4))
    q3 = _half_up(q2, str(10 ** 18))
    return f"(case when {d} = 0 then null else cast({q3} as double) / 100 end)"
