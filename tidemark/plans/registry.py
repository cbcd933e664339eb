"""The feature registry: what each feature is called, made of and asks for, and how it is computed.

A definition holds its Column builder, so a registered feature is computed; the registry also is the schema.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..clock import FeatureClock
from ..functions import liquidity, meanreversion, momentum, multitimeframe, recursive, returns, session_time, structure, volatility
from ..functions.frame import Frame

TYPES = {"double": T.DoubleType(), "short": T.ShortType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType(), "string": T.StringType()}

# Names, types and order of the columns of existing feature tables.
METADATA = (
    ("timestamp_utc", "timestamp", "open time of the primary bar"),
    ("venue", "string", "venue"),
    ("instrument", "string", "instrument"),
    ("timeframe", "string", "timeframe of the primary bars"),
    ("is_warmup", "boolean", "the series has too few bars yet for some feature"),
    ("has_data_gap", "boolean", "a feature's window may cross a gap in the bars"),
    ("is_valid", "boolean", "after warm-up, free of gaps, and nothing missing but by definition"),
    ("nan_feature_count", "short", "missing values among the columns that count"),
    ("domain_nan_feature_count", "short", "values missing by definition, as for zero volume"),
    ("input_dataset_version", "string", "version of the candles"),
    ("feature_set_version", "string", "version of the features"),
    ("session_definition_version", "string", "version of the sessions"),
)


@dataclass(frozen=True)
class FeatureColumn:
    name: str
    kind: str = "double"
    counts: bool = True  # whether a missing value counts as missing
    text: str = ""


@dataclass(frozen=True)
class Feature:
    """`build` gives the columns' values from a Frame; `stage` is 1 (from bars and shared columns) or 2 (from columns of stage 1 or filters)."""

    name: str
    family: str
    columns: tuple[FeatureColumn, ...]
    history: int
    build: Callable[[Frame], Column | tuple[Column, ...]] | None = None
    stage: int = 1
    params: dict = field(default_factory=dict)
    timeframe: str | None = None


class FeatureRegistry:
    """Ordered; a name registers once."""

    def __init__(self, features: Iterable[Feature] = ()):
        self._features: dict[str, Feature] = {}
        for f in features:
            self.register(f)

    def register(self, feature: Feature) -> None:
        if feature.name in self._features:
            raise ValueError(f"feature {feature.name!r} is registered already")
        taken = {c.name for c in self.columns} | {m[0] for m in METADATA}
        if clash := taken & {c.name for c in feature.columns}:
            raise ValueError(f"columns {sorted(clash)} are taken")
        self._features[feature.name] = feature

    def get(self, name: str) -> Feature:
        return self._features[name]

    def __len__(self) -> int:
        return len(self._features)

    def __iter__(self):
        return iter(self._features.values())

    @property
    def columns(self) -> list[FeatureColumn]:
        return [c for f in self for c in f.columns]

    @property
    def max_history(self) -> int:
        return max((f.history for f in self), default=0)

    def counts_by_family(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for f in self:
            out[f.family] = out.get(f.family, 0) + 1
        return out

    def history_by_family(self) -> dict[str, tuple[int, int]]:
        return {k: (min(h), max(h)) for k in self.counts_by_family() if (h := [f.history for f in self if f.family == k])}

    def schema(self) -> T.StructType:
        """Metadata, then features; every field is nullable, and its metadata says whether a NULL counts as missing."""
        fields = [T.StructField(n, TYPES[k], True, {"comment": t}) for n, k, t in METADATA]
        fields += [T.StructField(c.name, TYPES[c.kind], True, {"comment": c.text, "counts_as_nan": c.counts, "family": f.family, "history": f.history}) for f in self for c in f.columns]
        return T.StructType(fields)


def _one(name, family, history, build, kind="double", stage=1, **params) -> Feature:
    return Feature(name, family, (FeatureColumn(name, kind),), history, build, stage, params)


#: The recursive filters of the primary bars: those of bars, then the signal of the line that two of them make.
FILTERS = [recursive.ema(f"_ema{n}", "close", n) for n in (12, 26, 50)] + [recursive.wilder(f"_{d}{n}", f"_{d}", n) for n in (14, 28) for d in ("up", "down")] + [recursive.wilder(f"_atr{n}", "_tr", n) for n in (14, 28)]
SIGNAL = recursive.ema("_signal", "_line", 9, start=25)


def default_registry(clock: FeatureClock = FeatureClock(), gk_mode: str = "window", sessions: Mapping[str, tuple[int, int, int]] = session_time.SESSIONS) -> FeatureRegistry:
    """108 features, 116 columns."""
    r = FeatureRegistry()
    add = lambda *a, **k: r.register(_one(*a, **k))
    for n in (1, 3, 6, 12, 24, 48, 96):
        add(f"ret_log_cc_{n}", "returns", n + 1, lambda f, n=n: returns.log_return(f, n), n=n)
    for name, build in (("ret_log_oc", returns.open_close_return), ("price_body_ratio", returns.body_ratio), ("price_upper_wick_ratio", returns.upper_wick_ratio), ("price_lower_wick_ratio", returns.lower_wick_ratio), ("price_midpoint", returns.midpoint)):
        add(name, "returns", 1, build)
    for n in (6, 12, 24, 48):
        add(f"mom_roc_{n}", "momentum", n + 1, lambda f, n=n: momentum.rate_of_change(f, n), n=n)
    for n in (12, 24, 48):
        add(f"mom_slope_{n}", "momentum", n, lambda f, n=n: momentum.slope(f, n), n=n)
    for n in (12, 24, 48, 96):
        add(f"mom_sma_dev_{n}", "momentum", n, lambda f, n=n: momentum.sma_deviation(f, n), n=n)
    for n in (12, 26, 50):
        add(f"mom_ema_dev_{n}", "momentum", n, lambda f, n=n: momentum.ema_deviation(f, f"_ema{n}"), stage=2, n=n)
    add("mom_macd_hist", "momentum", 34, lambda f: momentum.macd_histogram(f, "_line", "_signal"), stage=2, fast=12, slow=26, signal=9)
    for n in (14, 28):
        add(f"mom_rsi_{n}", "momentum", n + 1, lambda f, n=n: momentum.rsi(f"_up{n}", f"_down{n}"), stage=2, n=n)
    for n in (14, 28):
        add(f"vol_atr_{n}", "volatility", n + 1, lambda f, n=n: F.col(f"_atr{n}"), stage=2, n=n)
        add(f"vol_atr_pct_{n}", "volatility", n + 1, lambda f, n=n: volatility.atr_percent(f, f"_atr{n}"), stage=2, n=n)
    for n in (12, 24, 48, 96):
        add(f"vol_realized_{n}", "volatility", n + 1, lambda f, n=n: volatility.realized(f, n), n=n)
    for n in (12, 24):
        add(f"vol_gk_realized_{n}", "volatility", n, lambda f, n=n: volatility.garman_klass(f, n, mode=gk_mode), n=n)
    add("vol_zscore_12_96", "volatility", 108, lambda f: volatility.zscore(f, F.col("vol_realized_12"), 96), stage=2, n=12, m=96)
    for name, build in (("liq_taker_buy_ratio", liquidity.taker_buy_ratio), ("liq_avg_trade_size", liquidity.average_trade_size), ("liq_dollar_volume", liquidity.dollar_volume), ("liq_delta_proxy", liquidity.delta_proxy)):
        add(name, "liquidity", 1, build)
    for n in (12, 48):
        add(f"liq_vwap_dev_{n}", "liquidity", n, lambda f, n=n: liquidity.vwap_deviation(f, n), n=n)
    for n in (12, 24, 48):
        add(f"liq_vol_ratio_{n}", "liquidity", n, lambda f, n=n: liquidity.volume_ratio(f, n), n=n)
    for n in (12, 48):
        add(f"liq_cum_delta_{n}", "liquidity", n, lambda f, n=n: liquidity.cumulative_delta(f, n), n=n)
    for n in (12, 24, 48, 96):
        add(f"ms_high_{n}", "structure", n, lambda f, n=n: structure.rolling_high(f, n), n=n)
        add(f"ms_low_{n}", "structure", n, lambda f, n=n: structure.rolling_low(f, n), n=n)
        add(f"ms_price_position_{n}", "structure", n, lambda f, n=n: structure.price_position(f, n), n=n)
    for n in (24, 96):
        add(f"ms_bars_since_high_{n}", "structure", n, lambda f, n=n: structure.bars_since_high(f, n), kind="short", n=n)
        add(f"ms_bars_since_low_{n}", "structure", n, lambda f, n=n: structure.bars_since_low(f, n), kind="short", n=n)
    for s in (3, 5):
        for side, build in (("high", structure.pivot_high), ("low", structure.pivot_low)):
            cols = (FeatureColumn(f"ms_is_pivot_{side}_{s}", "boolean"), FeatureColumn(f"ms_pivot_{side}_timestamp_{s}", "timestamp", False), FeatureColumn(f"ms_pivot_{side}_age_bars_{s}", "short", False))
            r.register(Feature(f"ms_pivot_{side}_{s}", "structure", cols, 2 * s + 1, lambda f, s=s, build=build: build(f, s), 1, {"s": s}))
    add("ms_consec_up_5", "structure", 6, structure.consecutive_up, kind="short")
    add("ms_consec_down_5", "structure", 6, structure.consecutive_down, kind="short")
    for n in (24, 48, 96):
        add(f"mr_zscore_{n}", "mean_reversion", n, lambda f, n=n: meanreversion.price_zscore(f, n), n=n)
    for n in (12, 48):
        add(f"mr_mean_dev_{n}", "mean_reversion", n, lambda f, n=n: meanreversion.mean_deviation(f, n), n=n)
    for n in (48, 96):
        add(f"mr_hurst_proxy_{n}", "mean_reversion", n + 1, lambda f, n=n: meanreversion.hurst_proxy(n), stage=2, n=n)
    for n in (24, 96):
        add(f"mr_autocorr_lag1_{n}", "mean_reversion", n + 2, lambda f, n=n: meanreversion.autocorrelation(f, n), n=n)
    for name, kind, build in (
        ("time_hour_utc", "short", lambda f: session_time.hour_utc(f.TS)),
        ("time_dow", "short", lambda f: session_time.day_of_week(f.TS)),
        ("time_hour_sin", "double", lambda f: session_time.hour_angle(f.TS)[0]),
        ("time_hour_cos", "double", lambda f: session_time.hour_angle(f.TS)[1]),
        ("time_dow_sin", "double", lambda f: session_time.day_angle(f.TS)[0]),
        ("time_dow_cos", "double", lambda f: session_time.day_angle(f.TS)[1]),
        ("time_session_flags", "short", lambda f: session_time.session_flags(f.TS, sessions)),
        ("time_bars_since_midnight", "short", lambda f: session_time.bars_since_midnight(f.TS, clock.primary)),
        ("time_bars_since_week_open", "short", lambda f: session_time.bars_since_week_open(f.TS, clock.primary)),
    ):
        add(name, "time", 1, build, kind=kind)
    for names, step, bars, tf in ((multitimeframe.LOW_COLUMNS, clock.htf_low, (5, 17, 15, 15, 16, 1, 16), "15m"), (multitimeframe.HIGH_COLUMNS, clock.htf_high, (5, 25, 15, 25, 24, 24, 1), "1h")):
        for name, k in zip(names, bars):
            r.register(Feature(name, "mtf", (FeatureColumn(name),), clock.history(k, step), None, 0, {}, tf))
    for name in multitimeframe.MICRO_COLUMNS:
        r.register(Feature(name, "mtf", (FeatureColumn(name),), 1, None, 0, {}, "1m"))
    return r
