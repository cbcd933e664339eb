"""Volatility."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frame import Frame, clamp, positive, ratio


def true_range(f: Frame, before: str = "_c1") -> Column:
    """From the second bar of a series."""
    c = F.col(before)
    return F.when(c.isNotNull(), F.greatest(f.H - f.L, F.abs(f.H - c), F.abs(f.L - c)))


def atr_percent(f: Frame, atr: str) -> Column:
    return ratio(F.col(atr), f.C)


def realized(f: Frame, n: int, returns: str = "_lr") -> Column:
    """Sample deviation of n log returns, all there; of the window's values alone, so nothing before it costs digits."""
    if n < 2:
        raise ValueError("a deviation needs two returns")
    r = F.col(returns)
    return F.when(F.col(f"{returns}_n") >= n, F.stddev_samp(r).over(f.w(n)))


def garman_klass_bar(f: Frame) -> Column:
    ok = positive(f.O, f.H, f.L, f.C) & (f.H >= f.L)
    hl, co = F.ln(f.H) - F.ln(f.L), F.ln(f.C) - F.ln(f.O)
    return F.when(ok, 0.5 * hl * hl - (2 * math.log(2) - 1) * co * co)


def _root(v: Column) -> Column:
    return F.when(v >= 0, F.sqrt(v)).when(F.abs(v) <= 1e-12, 0.0)


def garman_klass(f: Frame, n: int, bar: str = "_gk", mode: str = "window") -> Column:
    """Root of the mean Garman-Klass variance of n bars, all there.

    `window` is the true n-bar mean.  `legacy` is for users of tables made with known defects, and takes the mean from the
    columns of `garman_klass_legacy`, joined by bar.
    """
    x = F.col(bar)
    if mode == "window":
        return f.full(n, f.every(x, n, _root(F.avg(x).over(f.w(n)))))
    if mode != "legacy":
        raise ValueError(f"unknown mode {mode!r}")
    return _root(F.col(f"_gk_legacy_{n}"))


def garman_klass_legacy(rows: DataFrame, keys: tuple[str, ...], lengths: tuple[int, ...], bar: str = "_gk", index: str = "_rn", ts: str = "timestamp_utc") -> DataFrame:
    """Per bar, the means that a running sum with two defects gives: it drops the wrong bar, and goes stale.

    The sum starts with the first n - 1 bars.  Bar n - 1 has its true mean.  From then on a bar adds its own value and takes
    away the one n - 1 (not n) before, if both are there and the bar before was not found to lack any; else the bar has its
    true mean, or none if its window lacks a value, and the sum stays as it was.  A value that lacks at bar n - 1 itself goes
    unseen until it would be taken away.  As the sum depends on the whole past, a series is one task here, of narrow rows.
    """
    o = Window.partitionBy(*keys).orderBy(ts)
    upto, x, rn = o.rowsBetween(Window.unboundedPreceding, 0), F.col(bar), F.col(index)
    df = rows.select(*keys, ts, index, bar).withColumn("_lacks", x.isNull().cast("int")).withColumn("_before", F.sum("_lacks").over(upto))
    for n in lengths:
        window = o.rowsBetween(-(n - 1), 0)
        df = df.withColumns({"_in": F.sum("_lacks").over(window), "_mean": F.avg(x).over(window), "_out": F.lag(x, n - 1).over(o), "_head": F.max(F.when(rn == n - 1, F.col("_lacks"))).over(upto), "_first": F.sum(F.when(rn < n - 1, F.coalesce(x, F.lit(0.0))).otherwise(0.0)).over(upto)})
        unseen = (F.col("_head") == 1) & (rn < 2 * n - 2) & (F.col("_before") == 1)
        found = F.when(rn == n - 1, F.col("_before") - F.col("_head") > 0).otherwise((F.col("_in") > 0) & ~unseen)
        df = df.withColumn("_found", found).withColumn("_runs", (rn >= n) & x.isNotNull() & F.col("_out").isNotNull() & ~F.lag("_found").over(o))
        total = F.col("_first") + F.sum(F.when(F.col("_runs"), x - F.col("_out")).otherwise(0.0)).over(upto)
        df = df.withColumn(f"_gk_legacy_{n}", F.when(rn >= n - 1, F.when(F.col("_runs"), total / n).when(F.col("_in") == 0, F.col("_mean"))))
    return df.select(*keys, ts, *[f"_gk_legacy_{n}" for n in lengths])


def zscore(f: Frame, x: Column, n: int) -> Column:
    """z of x in its window of n values, all there; 0 if they don't vary; within 10."""
    mean, dev = F.avg(x).over(f.w(n)), F.stddev_samp(x).over(f.w(n))
    return f.every(x, n, F.when(dev > 0, clamp((x - mean) / dev, -10, 10)).otherwise(0.0))
