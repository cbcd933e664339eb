"""Momentum."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .frame import Frame, ratio
from .returns import EPSILON


def rate_of_change(f: Frame, n: int) -> Column:
    before = f.lag(f.C, n)
    return F.when(before > 0, (f.C - before) / before)


def slope(f: Frame, n: int, log_close: str = "_lnc") -> Column:
    """Least-squares slope of ln C over the window, times n, over |ln C|; NULL if a price in the window isn't positive.

    Spark's covariance works on deviations from the window's own means, so neither the bar's index nor the price level costs
    digits; the variance of n positions in a row is a constant.
    """
    if n < 2:
        raise ValueError("a slope needs two bars")
    y = F.col(log_close)
    raw = F.covar_pop(y, f.rn.cast("double")).over(f.w(n)) / ((n * n - 1) / 12.0)
    return f.full(n, f.every(y, n, raw * n / (F.abs(y) + EPSILON)))


def sma_deviation(f: Frame, n: int) -> Column:
    mean = F.avg(f.C).over(f.w(n))
    return f.full(n, ratio(f.C - mean, mean))


def ema_deviation(f: Frame, average: str) -> Column:
    return ratio(f.C - F.col(average), F.col(average))


def macd_histogram(f: Frame, line: str, signal: str) -> Column:
    return F.when(F.col(signal).isNotNull(), ratio(F.col(line) - F.col(signal), f.C))


def rsi(up: str, down: str) -> Column:
    """From Wilder's averages of rises and falls; 100 without falls, 0 without rises, 50 without either."""
    u, d = F.col(up), F.col(down)
    return F.when((d == 0) & (u == 0), 50.0).when(d == 0, 100.0).when(u == 0, 0.0).when(d > 0, 100.0 - 100.0 / (1.0 + u / d))
