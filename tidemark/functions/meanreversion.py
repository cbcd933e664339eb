"""Mean reversion."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .frame import Frame, clamp
from .returns import EPSILON
from .volatility import realized, zscore


def price_zscore(f: Frame, n: int) -> Column:
    return f.full(n, zscore(f, f.C, n))


def mean_deviation(f: Frame, n: int) -> Column:
    mean = F.avg(f.C).over(f.w(n))
    return f.full(n, (f.C - mean) / (mean + EPSILON))


def hurst_inputs(f: Frame, n: int, log_close: str = "_lnc") -> tuple[dict[str, Column], dict[str, Column]]:
    """Columns that `hurst_proxy` works on, in two steps: the window's log closes and mean return, then the walk around the mean.

    The running sum of returns is the log close but for a constant, which the range doesn't see.
    """
    y = F.col(log_close)
    first = {f"_rs_y_{n}": F.collect_list(y).over(f.w(n + 1)), f"_rs_m_{n}": (y - f.lag(y, n)) / n, f"_rs_s_{n}": realized(f, n)}
    return first, {f"_rs_z_{n}": F.expr(f"transform(_rs_y_{n}, (y, i) -> y - i * _rs_m_{n})")}


def hurst_proxy(n: int) -> Column:
    """Rescaled range of n log returns, all there, as ln(R/S) / ln n, within [0, 1]; 0.5 where R or S is zero."""
    span, dev = F.array_max(f"_rs_z_{n}") - F.array_min(f"_rs_z_{n}"), F.col(f"_rs_s_{n}")
    return F.when(dev.isNotNull(), F.when((dev > 0) & (span > 0), clamp(F.ln(span / dev) / math.log(n), 0, 1)).otherwise(0.5))


def autocorrelation(f: Frame, n: int, returns: str = "_lr") -> Column:
    """Correlation of returns with those one bar before, over n pairs, all there; 0 where either doesn't vary."""
    a, b = F.col(returns), F.col(f"{returns}1")
    over = lambda x: x.over(f.w(n))
    sa, sb = over(F.stddev_samp(a)), over(F.stddev_samp(b))
    value = F.when((sa > 0) & (sb > 0), clamp(over(F.covar_samp(a, b)) / (sa * sb), -1, 1)).otherwise(0.0)
    return F.when(F.col(f"{returns}_n") > n, value)
