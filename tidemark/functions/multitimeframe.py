"""Features of higher timeframes and of a bar's constituents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..clock import FeatureClock, floor_to
from . import liquidity, momentum, recursive, returns, structure, volatility
from .frame import Frame, clamp

LOW_COLUMNS = ("mtf_15m_ret_log_cc_4", "mtf_15m_ret_log_cc_16", "mtf_15m_mom_rsi_14", "mtf_15m_vol_atr_pct_14", "mtf_15m_price_position_16", "mtf_15m_liq_taker_buy_ratio", "mtf_15m_liq_vol_ratio_16")
HIGH_COLUMNS = ("mtf_1h_ret_log_cc_4", "mtf_1h_ret_log_cc_24", "mtf_1h_mom_rsi_14", "mtf_1h_vol_realized_24", "mtf_1h_price_position_24", "mtf_1h_mr_zscore_24", "mtf_1h_liq_taker_buy_ratio")
MICRO_COLUMNS = ("mtf_1m_vol_dispersion", "mtf_1m_taker_trend", "mtf_1m_return_skew")


def with_base(df: DataFrame, f: Frame) -> DataFrame:
    """Add what several features share: the previous close, and what follows from it."""
    first = {"_c1": f.lag(f.C, 1), "_lnc": F.when(f.C > 0, F.ln(f.C))}
    then = {
        "_lr": returns_of("_c1", f),
        "_tr": volatility.true_range(f),
        "_up": F.when(F.col("_c1").isNotNull(), F.greatest(f.C - F.col("_c1"), F.lit(0.0))),
        "_down": F.when(F.col("_c1").isNotNull(), F.greatest(F.col("_c1") - f.C, F.lit(0.0))),
        "_gk": volatility.garman_klass_bar(f),
    }
    df = df.withColumns(first).withColumns(then)
    return df.withColumns({"_lr1": f.lag(F.col("_lr"), 1), "_lr_n": f.since_missing(F.col("_lr"))})


def returns_of(before: str, f: Frame) -> Column:
    return F.when((f.C > 0) & (F.col(before) > 0), F.ln(f.C) - F.ln(F.col(before)))


def low_features(df: DataFrame, f: Frame, length: int) -> DataFrame:
    """The low higher timeframe's features, on its own bars."""
    df = with_base(df, f)
    df = recursive.apply(df, f, [recursive.wilder("_u14", "_up", 14), recursive.wilder("_d14", "_down", 14), recursive.wilder("_atr14", "_tr", 14)], length=length)
    values = (returns.log_return(f, 4), returns.log_return(f, 16), momentum.rsi("_u14", "_d14"), volatility.atr_percent(f, "_atr14"), structure.price_position(f, 16), liquidity.taker_buy_ratio(f), liquidity.volume_ratio(f, 16))
    return df.withColumns(dict(zip(LOW_COLUMNS, values)))


def high_features(df: DataFrame, f: Frame, length: int) -> DataFrame:
    df = with_base(df, f)
    df = recursive.apply(df, f, [recursive.wilder("_u14", "_up", 14), recursive.wilder("_d14", "_down", 14)], length=length)
    z = f.full(24, volatility.zscore(f, f.C, 24))
    values = (returns.log_return(f, 4), returns.log_return(f, 24), momentum.rsi("_u14", "_d14"), volatility.realized(f, 24), structure.price_position(f, 24), z, liquidity.taker_buy_ratio(f))
    return df.withColumns(dict(zip(HIGH_COLUMNS, values)))


def micro_features(micro: DataFrame, keys: tuple[str, ...], clock: FeatureClock, ts: str = "timestamp_utc") -> DataFrame:
    """One row per primary bar whose constituents are all there and complete, by partial aggregation.

    Dispersion and skew of volume and return, and the trend of the taker share; see the columns' definitions.
    """
    n = clock.micros
    bucket = floor_to(F.col(ts), clock.primary)
    at = ((F.unix_seconds(F.col(ts)) - F.unix_seconds(bucket)) / clock.micro).cast("int")
    v, tb, c, o = (F.col(x) for x in ("volume", "taker_buy_base_volume", "close", "open"))
    rows = micro.select(*keys, bucket.alias("_bucket"), at.alias("_k"), v.alias("_v"), F.when(v > 0, tb / v).alias("_share"), F.when((c > 0) & (o > 0), F.ln(c) - F.ln(o)).alias("_r"), "is_complete")
    middle = (n - 1) / 2
    sxx = sum((k - middle) ** 2 for k in range(n))
    last = F.max(F.when(F.col("_k") == n - 1, F.col("_r")))
    first = F.max(F.when(F.col("_k") == 0, F.col("_r")))
    whole = (F.count(F.lit(1)) == n) & (F.bit_count(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_k")))) == n) & F.bool_and("is_complete")
    mean, size = F.avg("_v"), F.sum(F.abs("_r"))
    parts = rows.groupBy(*keys, "_bucket").agg(
        whole.alias("_whole"),
        F.when(mean > 0, F.stddev_samp("_v") / mean).alias(MICRO_COLUMNS[0]),
        F.when(F.count("_share") == n, F.sum((F.col("_k") - middle) * F.col("_share")) / sxx).alias(MICRO_COLUMNS[1]),
        F.when(F.count("_r") == n, F.when(size > 0, clamp((last - first) / size, -1, 1)).otherwise(0.0)).alias(MICRO_COLUMNS[2]),
    )
    return parts.where("_whole").drop("_whole")
