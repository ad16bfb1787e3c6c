"""Money and ratio arithmetic.

Money stays in DECIMAL so sums do not depend on the order rows arrive in
after a shuffle.  Two rounding conventions exist in the reference: SQL
``ROUND`` (half away from zero, ``round``) and pandas/Python rounding
(half to even, ``bround``).  Ratios are rounded once, by the exact remainder.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesflow.functions._util import to_col

MONEY = "decimal(18,2)"
EXACT = "decimal(30,6)"


def as_money(c: Column | str) -> Column:
    return to_col(c).cast(MONEY)


def cents(c: Column | str) -> Column:
    """Money as a LONG count of cents (exact; sums of longs run in the
    aggregation fast path, sums of wide decimals go through BigDecimal)."""
    return (to_col(c).cast(MONEY) * F.lit(100)).cast("long")


def from_cents(c: Column | str) -> Column:
    """A LONG count of cents back to an exact DECIMAL with 2 digits."""
    return to_col(c).cast("decimal(20,0)") * F.lit(Decimal("0.01"))


def round_even(c: Column | str, scale: int = 0) -> Column:
    """pandas / Python rounding (half to even)."""
    return F.bround(to_col(c), scale)


def round_half_up(c: Column | str, scale: int = 0) -> Column:
    """SQL ROUND (half away from zero)."""
    return F.round(to_col(c), scale)


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used
    (an expression that is put into another one several times is planned and
    evaluated as often)."""
    return F.transform(F.array(value), use)[0]


def ratio(num: Column | str, den: Column | str, scale: int | None = 2,
          factor: int | float | None = None, half_even: bool = True,
          zero_when: Column | None = None) -> Column:
    """``round(num [* factor] / den, scale)`` as DOUBLE, rounded once.

    Both sides are decimals; quotient and remainder are exact, and the remainder
    says which way to round and what is a tie, whatever the size of the divisor.
    ``scale=None`` gives the plain quotient of doubles.  A zero or null
    denominator gives null, or 0 when ``zero_when`` holds.
    """
    n, d = to_col(num).cast(EXACT), to_col(den).cast(EXACT)
    if factor is not None:
        n = n * F.lit(Decimal(str(factor)))
    if scale is None:
        out = F.try_divide(n.cast("double"), d.cast("double"))
    else:
        # floor((2a + b) / 2b) rounds a / b half up; a tie leaves no remainder
        shift = F.lit(Decimal(10 ** scale))
        out = _bound(F.struct(n.alias("n"), d.alias("d")), lambda x: F.struct(
            (F.abs(x["n"] * shift) * 2 + F.abs(x["d"])).alias("a"), F.nullif(F.abs(x["d"]) * 2, F.lit(0).cast(EXACT)).alias("b"),
            F.when((x["n"] < 0) != (x["d"] < 0), -1).otherwise(1).alias("sign")))
        if half_even:
            out = _bound(out, lambda x: F.struct(((x["a"] - x["a"] % x["b"]) / x["b"]).cast("decimal(28,0)").alias("q"),
                                                 (x["a"] % x["b"] == 0).alias("tie"), x["sign"].alias("sign")))
            whole = _bound(out, lambda x: (x["q"] - F.when(x["tie"], x["q"] % 2).otherwise(0)) * x["sign"])
        else:
            whole = _bound(out, lambda x: ((x["a"] - x["a"] % x["b"]) / x["b"]).cast("decimal(28,0)") * x["sign"])
        out = (whole.cast("decimal(28,0)") * F.lit(Decimal(1).scaleb(-scale))).cast("double")
    if zero_when is not None:
        out = F.when(zero_when, F.lit(0.0)).otherwise(out)
    return out


def margin(amount: Column | str, rate: float = 0.42, scale: int = 2,
           as_int: bool = False) -> Column:
    """``round(amount * rate, scale)``, half to even; optionally as INT."""
    m = F.bround(as_money(amount) * F.lit(Decimal(str(rate))), scale)
    return m.cast("int") if as_int else m


def attainment(num: Column | str, den: Column | str, scale: int | None = 1,
               half_even: bool = True) -> Column:
    """Attainment percentage ``num / den * 100``."""
    return ratio(num, den, scale=scale, factor=100, half_even=half_even)
