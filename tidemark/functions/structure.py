"""Market structure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .frame import Frame, clamp


def rolling_high(f: Frame, n: int) -> Column:
    return f.full(n, F.max(f.H).over(f.w(n)))


def rolling_low(f: Frame, n: int) -> Column:
    return f.full(n, F.min(f.L).over(f.w(n)))


def price_position(f: Frame, n: int) -> Column:
    """Place of the close between the window's low and high; 0.5 if they are one."""
    high, low = F.max(f.H).over(f.w(n)), F.min(f.L).over(f.w(n))
    return f.full(n, F.when(high > low, clamp((f.C - low) / (high - low), 0, 1)).otherwise(0.5))


def bars_since_high(f: Frame, n: int) -> Column:
    """Bars since the window's high, the latest of equals."""
    return f.full(n, f.rn - F.max(F.struct(f.H.alias("x"), f.rn.alias("i"))).over(f.w(n))["i"]).cast("short")


def bars_since_low(f: Frame, n: int) -> Column:
    return f.full(n, f.rn + F.min(F.struct(f.L.alias("x"), (-f.rn).alias("i"))).over(f.w(n))["i"]).cast("short")


def _pivot(f: Frame, s: int, x: Column, extreme, beats) -> tuple[Column, Column, Column]:
    middle = f.lag(x, s)
    is_pivot = beats(middle, extreme(x).over(f.o.rowsBetween(-2 * s, -(s + 1)))) & beats(middle, extreme(x).over(f.o.rowsBetween(-(s - 1), 0)))
    flag = f.full(2 * s + 1, is_pivot)
    return flag, F.when(flag, f.lag(f.TS, s)), F.when(flag, F.lit(s)).cast("short")


def pivot_high(f: Frame, s: int) -> tuple[Column, Column, Column]:
    """(flag, time, age) of a high s bars ago that is above the s bars on either side; known at the current bar."""
    return _pivot(f, s, f.H, F.max, lambda a, b: a > b)


def pivot_low(f: Frame, s: int) -> tuple[Column, Column, Column]:
    return _pivot(f, s, f.L, F.min, lambda a, b: a < b)


def _run(f: Frame, cap: int, steps) -> Column:
    """Length of the run that ends at the bar: the least lag at which the step isn't one, up to cap."""
    lags = [f.C] + [f.lag(f.C, k) for k in range(1, cap + 1)]
    out = F.lit(cap)
    for k in reversed(range(cap)):
        out = F.when(~steps(lags[k], lags[k + 1]), F.lit(k)).otherwise(out)
    return f.full(cap + 1, out).cast("short")


def consecutive_up(f: Frame, cap: int = 5) -> Column:
    return _run(f, cap, lambda a, b: a > b)


def consecutive_down(f: Frame, cap: int = 5) -> Column:
    return _run(f, cap, lambda a, b: a < b)
