"""The feature engine: candles of four timeframes in, one row of 128 columns per primary bar out.

All windows of a series share one exchange and one sort; higher timeframes and constituents are joined to the narrow bars
before that, and a long series is cut in blocks with a halo (see `blocks`), so no task holds a whole series.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..clock import FeatureClock
from ..functions import Frame, meanreversion, multitimeframe, recursive, volatility
from ..functions.session_time import SESSION_VERSION, SESSIONS
from ..schema import KEY
from . import contracts
from ..operators.blocks import BUCKET_SECONDS, index_bars, previous, with_halo, without_halo
from .registry import FILTERS, METADATA, SIGNAL, FeatureRegistry, default_registry

FEATURE_SET_VERSION = "v2.0.0"

# Fixed values.
#: The columns that the sentinel way of counting looks at.
SENTINELS = ("vol_gk_realized_12", "vol_gk_realized_24", *multitimeframe.MICRO_COLUMNS, "mtf_15m_ret_log_cc_4", "mtf_1h_ret_log_cc_4", "liq_taker_buy_ratio", "liq_avg_trade_size", "liq_delta_proxy")


@dataclass(frozen=True)
class FeatureInput:
    """Candles by timeframe: the primary bars, and whichever of the others there are (missing ones leave NULLs)."""

    primary: DataFrame
    micro: DataFrame | None = None
    low: DataFrame | None = None
    high: DataFrame | None = None
    dataset_version: str = "1"
    session_version: str = SESSION_VERSION


@dataclass(frozen=True)
class FeatureEngine:
    """`block`: bars per block.  `segment_on_gap` restarts every series after a gap.  `complete_htf` uses only complete
    higher bars.  `nan_count`: `all` counts every column, `sentinels` only looks further where a sentinel is NULL."""

    clock: FeatureClock = FeatureClock()
    registry: FeatureRegistry | None = None
    gk_mode: str = "window"
    block: int = 8192
    segment_on_gap: bool = False
    complete_htf: bool = False
    nan_count: str = "all"
    sessions: Mapping[str, tuple[int, int, int]] = field(default_factory=lambda: dict(SESSIONS))
    keys: tuple[str, ...] = tuple(KEY)
    length: int = field(default=recursive.chunk_length([k.a for k in [*FILTERS, SIGNAL]]))
    halo: int = field(default=recursive.halo_length([k.a for k in [*FILTERS, SIGNAL]]) + 128)

    @property
    def features(self) -> FeatureRegistry:
        return self.registry or default_registry(self.clock, self.gk_mode, self.sessions)

    def _framed(self, df: DataFrame, keys: tuple[str, ...], narrow: list[str] | None = None) -> tuple[DataFrame, Frame]:
        rows = with_halo(index_bars(df, keys), self.block, self.halo).withColumn("_chunk", F.floor(F.col("_rn") / self.length))
        return rows, Frame((*keys, "_block"), ("_chunk", "timestamp_utc"))

    def _higher(self, df: DataFrame, build, columns: tuple[str, ...]) -> DataFrame:
        if self.complete_htf:
            df = df.where("is_complete")
        rows, frame = self._framed(df.select(*self.keys, "timestamp_utc", "open", "high", "low", "close", "volume", "quote_volume", "taker_buy_base_volume", "trade_count"), self.keys)
        return without_halo(build(rows, frame, self.length), self.block).select(*self.keys, F.col("timestamp_utc").alias("_htf"), *columns)

    def aligned(self, bars: DataFrame, inp: FeatureInput) -> DataFrame:
        """Primary bars with the columns of higher timeframes and constituents; left equi-joins on the aligned open time."""
        for df, build, columns, step in ((inp.low, multitimeframe.low_features, multitimeframe.LOW_COLUMNS, self.clock.htf_low), (inp.high, multitimeframe.high_features, multitimeframe.HIGH_COLUMNS, self.clock.htf_high)):
            if df is None:
                bars = bars.withColumns({c: F.lit(None).cast("double") for c in columns})
            else:
                bars = bars.withColumn("_htf", self.clock.align(F.col("timestamp_utc"), step)).join(self._higher(df, build, columns), [*self.keys, "_htf"], "left").drop("_htf")
        if inp.micro is None:
            return bars.withColumns({c: F.lit(None).cast("double") for c in multitimeframe.MICRO_COLUMNS})
        micro = multitimeframe.micro_features(inp.micro, self.keys, self.clock).withColumnRenamed("_bucket", "timestamp_utc")
        return bars.join(micro, [*self.keys, "timestamp_utc"], "left")

    def _islands(self, bars: DataFrame) -> DataFrame:
        """Add the number of gaps before each bar, found per time bucket as the bar indexes are."""
        cut = F.floor(F.unix_seconds("timestamp_utc") / BUCKET_SECONDS)
        rows = previous(bars.withColumn("_t", F.unix_seconds("timestamp_utc")), self.keys, "timestamp_utc", cut, ("_t",))
        rows = rows.withColumn("_new", F.coalesce((F.col("_t") - F.col("_prev__t") > self.clock.primary).cast("int"), F.lit(0))).withColumn("_bucket", cut)
        order = Window.partitionBy(*self.keys, "_bucket").orderBy("timestamp_utc")
        per = rows.groupBy(*self.keys, "_bucket").agg(F.sum("_new").alias("_n"))
        per = per.withColumn("_sum", F.coalesce(F.sum("_n").over(Window.partitionBy(*self.keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
        return rows.join(per, [*self.keys, "_bucket"]).withColumn("_island", F.col("_sum") + F.sum("_new").over(order)).drop("_bucket", "_t", "_prev__t", "_new", "_sum")

    def compute(self, inp: FeatureInput, *, timeframe: str | None = None, check: bool = False) -> DataFrame:
        """The feature table; with `check` the input contract is held first (one aggregation)."""
        if check:
            contracts.check_input(inp.primary, self.keys, low=inp.low, high=inp.high, micro=inp.micro)
        registry = self.features
        bars = inp.primary.select(*self.keys, "timeframe", "timestamp_utc", "open", "high", "low", "close", "volume", "quote_volume", "trade_count", "taker_buy_base_volume")
        bars = self.aligned(bars, inp)
        keys = self.keys
        if self.segment_on_gap:
            bars, keys = self._islands(bars), (*keys, "_island")
        rows, f = self._framed(bars, keys)
        rows = multitimeframe.with_base(rows, f).withColumn("_step", F.unix_seconds("timestamp_utc") - F.unix_seconds(F.lag("timestamp_utc").over(f.o)))
        if self.gk_mode == "legacy":
            narrow = index_bars(bars.select(*keys, "timestamp_utc", "open", "high", "low", "close"), keys).withColumn("_gk", volatility.garman_klass_bar(Frame(keys)))
            rows = rows.join(volatility.garman_klass_legacy(narrow, keys, (12, 24)), [*keys, "timestamp_utc"])
        first, then = self._hurst(registry, f)
        rows = rows.withColumns(self._values(registry, f, 1) | first | {"_gap_at": F.max(F.when(F.col("_step") > self.clock.primary, F.col("_rn"))).over(f.o.rowsBetween(Window.unboundedPreceding, 0))}).withColumns(then)
        rows = recursive.apply(rows, f, FILTERS, length=self.length).withColumn("_line", F.col("_ema12") - F.col("_ema26"))
        rows = recursive.apply(rows, f, [SIGNAL], length=self.length)
        rows = rows.withColumns(self._values(registry, f, 2))
        return self._assembled(without_halo(rows, self.block), registry, inp, timeframe)

    @staticmethod
    def _hurst(registry: FeatureRegistry, f: Frame) -> tuple[dict, dict]:
        steps = [meanreversion.hurst_inputs(f, feature.params["n"]) for feature in registry if feature.name.startswith("mr_hurst_proxy_")]
        return {k: v for s in steps for k, v in s[0].items()}, {k: v for s in steps for k, v in s[1].items()}

    @staticmethod
    def _values(registry: FeatureRegistry, f: Frame, stage: int) -> dict:
        out = {}
        for feature in registry:
            if feature.build is not None and feature.stage == stage:
                values = feature.build(f)
                out |= dict(zip([c.name for c in feature.columns], values if isinstance(values, tuple) else (values,)))
        return out

    def _assembled(self, rows: DataFrame, registry: FeatureRegistry, inp: FeatureInput, timeframe: str | None) -> DataFrame:
        warm, need = F.col("_rn") < registry.max_history, registry.max_history
        gap = F.coalesce(F.col("_rn") - F.col("_gap_at") < need, F.lit(False))
        names = {c.name for c in registry.columns}
        domain = F.when(F.col("volume") == 0, 3).otherwise(0)
        for c in ("vol_gk_realized_12", "vol_gk_realized_24", "mtf_1m_vol_dispersion", "mtf_1m_taker_trend"):
            if c in names:
                domain = domain + F.when(F.col(c).isNull() & ~F.col("is_warmup") & ~F.col("has_data_gap"), 1).otherwise(0)
        missing = F.expr(" + ".join(["0", *(f"CAST(`{c.name}` IS NULL AS INT)" for c in registry.columns if c.counts)]))
        if self.nan_count == "sentinels":
            seen = F.expr(" OR ".join(f"`{c}` IS NULL" for c in SENTINELS))
            missing = F.when(F.col("is_warmup") | F.col("has_data_gap") | (F.col("domain_nan_feature_count") > 0) | seen, missing).otherwise(0)
        elif self.nan_count != "all":
            raise ValueError(f"unknown way of counting {self.nan_count!r}")
        rows = rows.withColumns({"is_warmup": warm, "has_data_gap": gap}).withColumn("domain_nan_feature_count", domain.cast("short")).withColumn("nan_feature_count", missing.cast("short"))
        quality = F.greatest(F.lit(0), F.col("nan_feature_count") - F.col("domain_nan_feature_count"))
        rows = rows.withColumns(
            {
                "is_valid": ~F.col("is_warmup") & ~F.col("has_data_gap") & (quality == 0),
                "timeframe": F.lit(timeframe) if timeframe else F.col("timeframe"),
                "input_dataset_version": F.lit(inp.dataset_version),
                "feature_set_version": F.lit(FEATURE_SET_VERSION),
                "session_definition_version": F.lit(inp.session_version),
            }
        )
        return rows.select(*[F.col(n).cast(k) for n, k, _ in METADATA], *[F.col(c.name).cast(c.kind) for c in registry.columns])
