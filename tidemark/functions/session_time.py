"""Session and time features."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# The session definition, version 1.0.0.
#: Sessions by name: first hour, hour after the last (UTC, no wrap at midnight), bit.
SESSIONS = {"asian": (0, 8, 1), "london": (7, 16, 2), "new_york": (13, 22, 4)}
SESSION_VERSION = "1.0.0"


def hour_utc(ts: Column) -> Column:
    return F.hour(ts).cast("short")


def day_of_week(ts: Column) -> Column:
    """Monday 0 to Sunday 6."""
    return F.weekday(ts).cast("short")


def hour_angle(ts: Column) -> tuple[Column, Column]:
    x = F.lit(2 * math.pi) * F.hour(ts) / 24
    return F.sin(x), F.cos(x)


def day_angle(ts: Column) -> tuple[Column, Column]:
    x = F.lit(2 * math.pi) * F.weekday(ts) / 7
    return F.sin(x), F.cos(x)


def session_flags(ts: Column, sessions: Mapping[str, tuple[int, int, int]] = SESSIONS) -> Column:
    """Bits of the sessions that are open, or-ed."""
    hour, out = F.hour(ts), F.lit(0)
    for first, after, bit in sessions.values():
        out = out.bitwiseOR(F.when((hour >= first) & (hour < after), bit).otherwise(0))
    return out.cast("short")


def bars_since_midnight(ts: Column, step: int = 300) -> Column:
    return F.floor((F.hour(ts) * 3600 + F.minute(ts) * 60) / step).cast("short")


def bars_since_week_open(ts: Column, step: int = 300) -> Column:
    return (F.weekday(ts) * (86400 // step) + F.floor((F.hour(ts) * 3600 + F.minute(ts) * 60) / step)).cast("short")
