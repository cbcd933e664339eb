"""Liquidity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .frame import Frame, clamp, ratio


def taker_buy_ratio(f: Frame) -> Column:
    return clamp(ratio(f.TB, f.V), 0, 1)


def average_trade_size(f: Frame) -> Column:
    return F.when(f.V > 0, ratio(f.V, f.N))


def dollar_volume(f: Frame) -> Column:
    return f.QV


def delta_proxy(f: Frame) -> Column:
    return clamp(ratio(2 * f.TB - f.V, f.V), -1, 1)


def vwap_deviation(f: Frame, n: int) -> Column:
    vwap = ratio(F.sum(f.QV).over(f.w(n)), F.sum(f.V).over(f.w(n)))
    return f.full(n, ratio(f.C - vwap, vwap))


def volume_ratio(f: Frame, n: int) -> Column:
    return f.full(n, ratio(f.V, F.avg(f.V).over(f.w(n))))


def cumulative_delta(f: Frame, n: int) -> Column:
    return f.full(n, clamp(ratio(F.sum(2 * f.TB - f.V).over(f.w(n)), F.sum(f.V).over(f.w(n))), -1, 1))
