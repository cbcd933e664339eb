"""Returns and bar geometry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .frame import Frame, clamp, positive

#: Keeps a flat bar's ratios defined.
EPSILON = 1e-8


def log_return(f: Frame, n: int) -> Column:
    """ln C[t] - ln C[t-n], both positive."""
    if n < 1:
        raise ValueError("a return needs a lag of at least one bar")
    before = f.lag(f.C, n)
    return F.when(positive(f.C, before), F.ln(f.C) - F.ln(before))


def open_close_return(f: Frame) -> Column:
    return F.when(positive(f.C, f.O), F.ln(f.C) - F.ln(f.O))


def _of_range(f: Frame, part: Column) -> Column:
    span = f.H - f.L + EPSILON
    return F.when(span > 0, clamp(part / span, 0, 1))


def body_ratio(f: Frame) -> Column:
    return _of_range(f, F.abs(f.C - f.O))


def upper_wick_ratio(f: Frame) -> Column:
    return _of_range(f, f.H - F.greatest(f.O, f.C))


def lower_wick_ratio(f: Frame) -> Column:
    return _of_range(f, F.least(f.O, f.C) - f.L)


def midpoint(f: Frame) -> Column:
    return (f.H + f.L) / 2
