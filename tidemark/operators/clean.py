"""Bounds and the three policies for repeated candles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import SERIES

VALUES = ("open", "high", "low", "close", "volume")


class OverlapConflict(ValueError):
    """Two sources tell different candles for one time."""


def within(candles: DataFrame, start=None, end=None, ts: str = "timestamp_utc") -> DataFrame:
    """start <= time < end (ISO texts of one form, or datetimes), either may be None; pushed to the scan."""
    if start is not None and end is not None and end <= start:
        raise ValueError("the end must come after the start")
    if start is not None:
        candles = candles.where(F.col(ts) >= F.lit(start).cast("timestamp"))
    return candles if end is None else candles.where(F.col(ts) < F.lit(end).cast("timestamp"))


def drop_exact_duplicates(candles: DataFrame, *, seq: str, series: list[str] = SERIES, values: tuple[str, ...] = VALUES) -> DataFrame:
    """Policy A: of candles of one time and equal values the first by `seq` stays; conflicting ones stay all, for the validator."""
    order = Window.partitionBy(*series, "timestamp_utc", *values).orderBy(seq)
    return candles.withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")


def keep_last(candles: DataFrame, *, seq: str, series: list[str] = SERIES) -> DataFrame:
    """Policy B: of candles of one time the last by `seq` stays; an aggregation, so partial before the shuffle."""
    rest = [c for c in candles.columns if c not in (*series, "timestamp_utc")]
    best = candles.groupBy(*series, "timestamp_utc").agg(F.max_by(F.struct(*rest), seq).alias("_v"))
    return best.select(*series, "timestamp_utc", "_v.*").select(*candles.columns)


def overlap_conflicts(existing: DataFrame, new: DataFrame, *, tolerance: float = 1e-4, series: list[str] = SERIES) -> DataFrame:
    """Times that both have, with open, close or volume further apart than `tolerance`."""
    both = existing.alias("a").join(new.alias("b"), [*series, "timestamp_utc"])
    differs = F.lit(False)
    for c in ("open", "close", "volume"):
        differs = differs | (F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) > tolerance)
    return both.where(differs).select(*series, "timestamp_utc", *[F.col(f"{s}.{c}").alias(f"{n}_{c}") for s, n in (("a", "existing"), ("b", "new")) for c in ("open", "close", "volume")])


def merge_overlap(existing: DataFrame, new: DataFrame, *, tolerance: float = 1e-4, series: list[str] = SERIES) -> DataFrame:
    """Policy C: existing candles win; a conflict raises OverlapConflict before anything is merged."""
    if (conflict := overlap_conflicts(existing, new, tolerance=tolerance, series=series).first()) is not None:
        raise OverlapConflict(f"candles differ at {conflict['timestamp_utc']}")
    return existing.unionByName(new.join(existing.select(*series, "timestamp_utc"), [*series, "timestamp_utc"], "left_anti"))
