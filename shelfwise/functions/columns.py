"""Column-expression helpers.

Every helper returns a ``Column`` built from built-in functions, so it stays
inside whole-stage codegen. The ``*_sql`` twins emit the same arithmetic as
SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import MONTH_NAMES

def col_(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """NaN never enters the engine: Spark orders NaN above every number, so a
    NaN would pass ``> 5`` tests that are false in pandas."""
    return F.nanvl(col_(c), F.lit(None).cast("double"))


def safe_div(num: Column | str, den: Column | str) -> Column:
    """``num / den`` with a zero denominator giving NULL (ANSI mode raises)."""
    return col_(num) / F.nullif(col_(den), F.lit(0))


def clip_keep_null(c: Column | str, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Clip into [lo, hi]; NULL stays NULL (``greatest``/``least`` skip NULLs)."""
    x = col_(c)
    return F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(hi)), F.lit(lo)))


def sum0(c: Column | str) -> Column:
    """Sum that is 0, not NULL, for an empty or all-NULL group."""
    return F.coalesce(F.sum(col_(c)), F.lit(0))


def month_start(c: Column | str) -> Column:
    return F.trunc(col_(c), "MM")


def month_short_name(n: Column | str) -> Column:
    """1..12 → Jan..Dec; anything else kept as its text."""
    n = col_(n)
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    return F.when(n.between(1, 12), F.element_at(names, n.cast("int"))).otherwise(n.cast("string"))


# --------------------------------------------------------------------------
# Python-exact rounding.
#
# Python's ``round(x, d)`` and ``f"{x:.{d}f}"`` round the exact binary value
# of ``x`` half-to-even. Spark's ``bround``/``format_string`` round the
# shortest decimal text instead, which differs whenever that text ends in a
# 5 at the rounding digit (20.15 is stored as 20.1499…, Python gives 20.1,
# ``bround`` 20.2). The helpers below decide the side of such a tie exactly
# with double arithmetic: p + e == x * 2·10^d with no rounding error
# (Dekker's product with a Veltkamp split of x), m = rint(p). An odd m is a
# decimal tie neighbourhood and the sign of (p - m) + e says which way the
# exact value leans.
# --------------------------------------------------------------------------
_VELTKAMP = 134217729.0  # 2**27 + 1


def py_round(c: Column | str, digits: int) -> Column:
    x = col_(c)
    scale = float(2 * 10 ** digits)
    p = x * F.lit(scale)
    split = x * F.lit(_VELTKAMP)
    hi = split - (split - x)
    lo = x - hi
    err = (hi * F.lit(scale) - p) + lo * F.lit(scale)
    m = F.rint(p)
    side = F.signum((p - m) + err)
    down = (m - F.lit(1.0)) / F.lit(2.0)
    up = (m + F.lit(1.0)) / F.lit(2.0)
    k = (F.when(F.pmod(m, F.lit(2.0)) == 0, m / F.lit(2.0))
         .when(side > 0, up)
         .when(side < 0, down)
         .when(F.pmod(down, F.lit(2.0)) == 0, down)
         .otherwise(up))
    value = k / F.lit(float(10 ** digits))
    # keep the sign of x (Python gives -0.0 for round(-0.04, 1))
    return F.when(x < 0, -F.abs(value)).otherwise(value)


def py_round_sql(expr: str, digits: int) -> str:
    """SQL twin of :func:`py_round` (``expr`` is evaluated several times)."""
    x = f"({expr})"
    scale = f"{float(2 * 10 ** digits)!r}"
    p = f"({x} * {scale})"
    split = f"({x} * {_VELTKAMP!r})"
    hi = f"({split} - ({split} - {x}))"
    lo = f"({x} - {hi})"
    err = f"(({hi} * {scale} - {p}) + {lo} * {scale})"
    m = f"round_even({p}, 0)"
    side = f"sign(({p} - {m}) + {err})"
    down = f"(({m} - 1.0) / 2.0)"
    up = f"(({m} + 1.0) / 2.0)"
    k = (f"(CASE WHEN ({m} - 2.0 * floor({m} / 2.0)) = 0 THEN {m} / 2.0 "
         f"WHEN {side} > 0 THEN {up} WHEN {side} < 0 THEN {down} "
         f"WHEN ({down} - 2.0 * floor({down} / 2.0)) = 0 THEN {down} ELSE {up} END)")
    value = f"({k} / {float(10 ** digits)!r})"
    return f"(CASE WHEN {x} < 0 THEN -abs({value}) ELSE {value} END)"


# Exact, order-independent sums of doubles. Spark's ``sum`` of doubles
# depends on the partitioning (the merge order of partial sums), so the same
# query gives last-bit differences between runs, clusters and engines; when
# a result is then rounded to cents, decimal-structured money sits on a .xx5
# tie about once in a hundred and the last bit decides. ``dsum`` splits each
# value at 2^-10: the integer part of x·2^10 (exact as BIGINT for |x| below
# 9e15) is summed exactly as DECIMAL(38,0) — a BIGINT sum would overflow
# once a group's total passes ~9e15, e.g. a skewed group at 100 TB — and
# the fraction in [0, 1) as a double (its rounding error is orders of
# magnitude below one unit of the result).
_SPLIT_SCALE = float(2 ** 10)
EXACT_TYPE = "decimal(38,0)"


def dsum(c: Column | str) -> Column:
    y = col_(c) * F.lit(_SPLIT_SCALE)
    hi = F.floor(y)
    return ((F.sum(hi.cast("bigint").cast(EXACT_TYPE)).cast("double") + F.sum(y - hi))
            / F.lit(_SPLIT_SCALE))


def dsum0(c: Column | str) -> Column:
    """:func:`dsum`, 0 for an empty or all-NULL group."""
    return F.coalesce(dsum(c), F.lit(0.0))


def davg(c: Column | str) -> Column:
    """Mean from :func:`dsum` (NULL when no value is present)."""
    return dsum(c) / F.nullif(F.count(col_(c)), F.lit(0))


def dsum_sql(expr: str) -> str:
    y = f"(({expr}) * {_SPLIT_SCALE!r})"
    return (f"((CAST(sum(CAST(CAST(floor({y}) AS BIGINT) AS {EXACT_TYPE.upper()})) AS DOUBLE) "
            f"+ sum({y} - floor({y}))) / {_SPLIT_SCALE!r})")


def dsum0_sql(expr: str) -> str:
    return f"coalesce({dsum_sql(expr)}, CAST(0.0 AS DOUBLE))"


def davg_sql(expr: str) -> str:
    return f"({dsum_sql(expr)} / nullif(count({expr}), 0))"


def np_round(c: Column | str, digits: int) -> Column:
    """numpy's ``round``: rint(x·10^d) / 10^d (what pandas ``.round`` and
    ``round()`` of a numpy float compute; ties of the scaled binary value go
    to even)."""
    scale = F.lit(float(10 ** digits))
    return F.rint(col_(c) * scale) / scale


def np_round_sql(expr: str, digits: int) -> str:
    scale = f"{float(10 ** digits)!r}"
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"


def py_format(c: Column | str, digits: int, thousands: bool = False) -> Column:
    """``f"{x:.{d}f}"`` (``f"{x:,.{d}f}"`` with ``thousands``)."""
    pattern = f"%{',' if thousands else ''}.{digits}f"
    return F.format_string(pattern, py_round(c, digits))


def py_format_sql(expr: str, digits: int, thousands: bool = False) -> str:
    pattern = f"%{',' if thousands else ''}.{digits}f"
    return f"printf('{pattern}', {py_round_sql(expr, digits)})"


# --------------------------------------------------------------------------
# Comparison grid.
#
# Two engines (or two Spark partitionings) sum floats in different orders and
# disagree in the last bits. Decimal rounding cannot hide that here: retail
# data is decimal-structured (2-dp prices averaged over 16 or 32 lines), so
# exact means sit on decimal ties and a 1-ulp difference flips the digit.
# ``grid_round`` keeps ``bits`` significant bits instead: scaling by a power
# of two, adding 0.5 and flooring are exact operations, so both engines give
# bit-identical output. Grid boundaries are odd multiples of 2^(e-bits); a
# value with d decimals can only sit on one when e >= bits - d, so with 32
# bits 4-dp money is safe below 2^28 (single precision, 24 bits, is not:
# 1204208.6875 is a float midpoint).
# --------------------------------------------------------------------------
def grid_round(c: Column | str, bits: int = 32) -> Column:
    x = col_(c)
    a = F.abs(x)
    p = F.pow(F.lit(2.0), F.floor(F.log2(a)))          # 2^e, e possibly off by one
    top = (F.when(p > a, p * F.lit(0.5)).when(p * F.lit(2.0) <= a, p * F.lit(2.0))
           .otherwise(p))                                # exact 2^floor(log2 a)
    q = top * F.lit(2.0 ** -bits)
    return F.when(x == 0, F.lit(0.0)).otherwise(F.floor(x / q + F.lit(0.5)).cast("double") * q)


def grid_round_sql(expr: str, bits: int = 32) -> str:
    x = f"({expr})"
    a = f"abs({x})"
    p = f"pow(2.0, floor(log2(CASE WHEN {x} = 0 THEN 1.0 ELSE {a} END)))"
    top = f"(CASE WHEN {p} > {a} THEN {p} * 0.5 WHEN {p} * 2.0 <= {a} THEN {p} * 2.0 ELSE {p} END)"
    q = f"({top} * {2.0 ** -bits!r})"
    return (f"(CASE WHEN {x} = 0 THEN CAST(0.0 AS DOUBLE) "
            f"ELSE CAST(floor({x} / {q} + 0.5) AS DOUBLE) * {q} END)")
