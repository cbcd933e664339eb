"""How features see a series: windows over its bars, with full-frame guards."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def clamp(x: Column, low: float, high: float) -> Column:
    """x within [low, high]; NULL stays NULL (greatest and least skip NULLs by themselves)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), x)))


def positive(*columns: Column) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & (c > 0)
    return out


def ratio(over: Column, under: Column) -> Column:
    """over / under where under is positive, else NULL."""
    return F.when(under > 0, over / under)


@dataclass(frozen=True)
class Frame:
    """Partition columns, order columns, and the column of the bar's 0-based index in its series."""

    keys: tuple[str, ...] = ("venue", "instrument")
    order: tuple[str, ...] = ("timestamp_utc",)
    index: str = "_rn"
    columns: dict[str, str] = field(default_factory=dict)
    _windows: dict[tuple, WindowSpec] = field(default_factory=dict)  # made once: each is a chain of calls to the JVM

    def __getattr__(self, name: str) -> Column:
        names = {"C": "close", "O": "open", "H": "high", "L": "low", "V": "volume", "QV": "quote_volume", "TB": "taker_buy_base_volume", "N": "trade_count", "TS": "timestamp_utc"}
        if name in names:
            return F.col(self.columns.get(name, names[name]))
        raise AttributeError(name)

    @property
    def rn(self) -> Column:
        return F.col(self.index)

    @property
    def o(self) -> WindowSpec:
        if () not in self._windows:
            self._windows[()] = Window.partitionBy(*self.keys).orderBy(*self.order)
        return self._windows[()]

    def w(self, n: int, skip: int = 0) -> WindowSpec:
        """The n rows that end `skip` rows before the current one."""
        if (n, skip) not in self._windows:
            self._windows[n, skip] = self.o.rowsBetween(-(n - 1) - skip, -skip)
        return self._windows[n, skip]

    def lag(self, x: Column, n: int) -> Column:
        return F.lag(x, n).over(self.o)

    def full(self, n: int, value: Column) -> Column:
        """value where n bars are there, else NULL (Spark's frames are partial at the start)."""
        return F.when(self.rn >= n - 1, value)

    def since_missing(self, x: Column) -> Column:
        """How many values of x in a row, up to this one, are there: one step per row, whatever the window it is held against."""
        last = F.max(F.when(x.isNull(), self.rn)).over(self.o.rowsBetween(Window.unboundedPreceding, 0))
        first = F.min(self.rn).over(self.o.rowsBetween(Window.unboundedPreceding, 0))
        return self.rn - F.coalesce(last, first - 1)

    def every(self, x: Column, n: int, value: Column) -> Column:
        """value where the last n values of x are there and not NULL."""
        return F.when(F.count(x).over(self.w(n)) == n, value)
