"""Recursive filters s[t] = a s[t-1] + b x[t] from an average as seed, as a blocked affine scan in window functions.

Bars are cut in chunks.  Within a chunk s is a running sum: a^(j+1) (carry + sum of u[i] a^-(i+1)).  Chunks are so long
that a^length is below 1e-40, so the carry is what the chunk before made, and nothing older shows in a double.  One pass,
no Python, linear in the bars; chunks share the sort of the series' other windows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .frame import Frame


@dataclass(frozen=True)
class Filter:
    """A filter's result column, its input column, its decay, its weight, the index of the seed, and the seed's bars."""

    name: str
    x: str
    a: float
    b: float
    seed_at: int
    seed_bars: int


def ema(name: str, x: str, n: int, start: int = 0) -> Filter:
    """Exponential average, alpha = 2 / (n + 1); the seed is the mean of the first n values, which begin at index `start`."""
    return Filter(name, x, (n - 1) / (n + 1), 2 / (n + 1), start + n - 1, n)


def wilder(name: str, x: str, n: int) -> Filter:
    """Wilder's average of values that begin at index 1: the seed at index n is the mean of the first n."""
    return Filter(name, x, (n - 1) / n, 1 / n, n, n)


def chunk_length(decays: list[float]) -> int:
    """Bars after which the slowest decay is below 1e-40; the fastest must then still be above 1e-280."""
    n = max((math.ceil(40 / -math.log10(a)) for a in decays if a > 0), default=1)
    if any(a > 0 and -math.log10(a) * n > 280 for a in decays):
        raise ValueError("decays are too far apart for one chunk length; run the filters apart")
    return n


def halo_length(decays: list[float]) -> int:
    """Bars after which the start of a series no longer shows in a double."""
    return max((math.ceil(17.5 / -math.log10(a)) for a in decays if a > 0), default=1)


def apply(df: DataFrame, f: Frame, filters: list[Filter], *, chunk: str = "_chunk", length: int) -> DataFrame:
    """Add one column per filter; NULL before its seed.  `chunk` must be index div `length` and lead the frame's order."""
    step = F.col(f.index) % length
    within = Window.partitionBy(*f.keys, chunk).orderBy(*[c for c in f.order if c != chunk]).rowsBetween(Window.unboundedPreceding, 0)
    inputs: dict[str, Column] = {}
    for k in filters:
        x = F.col(k.x)
        inputs[f"_u_{k.name}"] = F.when(f.rn < k.seed_at, 0.0).when(f.rn == k.seed_at, F.avg(x).over(f.w(k.seed_bars))).otherwise(x * k.b) if k.a else F.when(f.rn >= k.seed_at, x).otherwise(0.0)
    df = df.withColumns(inputs)
    df = df.withColumns({f"_s_{k.name}": F.sum(F.col(f"_u_{k.name}") * F.pow(F.lit(k.a), -(step + 1).cast("double"))).over(within) for k in filters if k.a})
    ends = F.col(f.index) % length == length - 1
    before = f.o.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({f"_c_{k.name}": F.coalesce(F.last(F.when(ends, F.col(f"_s_{k.name}")), ignorenulls=True).over(before), F.lit(0.0)) * (k.a**length) for k in filters if k.a})
    out = {}
    for k in filters:
        state = F.pow(F.lit(k.a), (step + 1).cast("double")) * (F.col(f"_c_{k.name}") + F.col(f"_s_{k.name}")) if k.a else F.col(f"_u_{k.name}")
        out[k.name] = F.when(f.rn >= k.seed_at, state)
    return df.withColumns(out).drop(*[f"{p}{k.name}" for k in filters for p in ("_u_", "_s_", "_c_")])
