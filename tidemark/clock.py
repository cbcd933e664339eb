"""Clocks: bucket floors, the alignment of higher timeframes, and what they need of history."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from .schema import seconds


def floor_to(ts: Column, step: int) -> Column:
    """Start of the bucket of `step` seconds, counted from the epoch in UTC."""
    return F.timestamp_seconds((F.unix_seconds(ts) - F.pmod(F.unix_seconds(ts), F.lit(step))))


def floor_to_timeframe(ts: Column, timeframe: str) -> Column:
    return floor_to(ts, seconds(timeframe))


@dataclass(frozen=True)
class FeatureClock:
    """Seconds of the primary bars, of their constituents and of the two higher timeframes (low, high)."""

    primary: int = 300
    micro: int = 60
    htf_low: int = 900
    htf_high: int = 3600

    def align(self, ts: Column, step: int) -> Column:
        """Open time of the last bar of `step` seconds that is closed when the primary bar opened at `ts` closes."""
        return floor_to(F.timestamp_seconds(F.unix_seconds(ts) - (step - self.primary)), step)

    def history(self, bars: int, step: int) -> int:
        """Primary bars that `bars` bars of `step` seconds ask for."""
        ratio = step // self.primary
        return bars * ratio + ratio - 1

    @property
    def micros(self) -> int:
        return self.primary // self.micro

    @property
    def per_day(self) -> int:
        return 86400 // self.primary
