"""Input and output contracts of the feature engine: counts of violations over all rows, in one aggregation each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .registry import FeatureRegistry


class ContractError(ValueError):
    """Rows break a contract; the message has the counts."""


def _count(rule: Column) -> Column:
    return F.coalesce(F.sum(F.when(rule, 1).otherwise(0)), F.lit(0)).cast("long")


def input_violations(bars: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row: bars, and violations by rule.  Time must ascend strictly in each series, which here means: not repeat."""
    rules = {
        "non_positive_price": F.least("open", "high", "low", "close") <= 0,
        "high_too_low": (F.col("high") < F.col("low")) | (F.col("high") < F.col("open")) | (F.col("high") < F.col("close")),
        "low_too_high": (F.col("low") > F.col("open")) | (F.col("low") > F.col("close")),
        "negative_volume": F.least("volume", "quote_volume", "taker_buy_base_volume") < 0,
        "negative_trade_count": F.col("trade_count") < 0,
    }
    # Repeats are counted per (series, time), so that no series is one task.
    groups = bars.groupBy(*keys, "timestamp_utc").agg(F.count(F.lit(1)).alias("n"), *[_count(c).alias(k) for k, c in rules.items()])
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("bars"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("repeated_time"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in rules])


def check_input(bars: DataFrame, keys: tuple[str, ...], **contexts: DataFrame | None) -> None:
    """Raise ContractError unless the primary bars and every supplied context are non-empty and keep the rules."""
    for name, df in {"primary": bars, **contexts}.items():
        if df is None:
            continue
        row = input_violations(df, keys).first().asDict()
        if not row.pop("bars"):
            raise ContractError(f"{name} has no bars")
        broken = {k: v for k, v in row.items() if v and (name == "primary" or k == "repeated_time")}
        if broken:
            raise ContractError(f"{name} breaks {broken}")


def output_violations(features: DataFrame, registry: FeatureRegistry) -> DataFrame:
    """One row: rows, and violations by rule, over all rows."""
    doubles = [c.name for c in registry.columns if c.kind == "double"]
    names = {c.name for c in registry.columns}

    def some(columns, rule) -> Column:
        out = F.lit(False)
        for c in columns:
            out = out | F.coalesce(rule(F.col(c)), F.lit(False))
        return out

    rules = {
        "infinite": some(doubles, lambda c: F.abs(c) == float("inf")),
        "not_a_number": some(doubles, lambda c: F.isnan(c)),
        "zscore_range": some([c for c in doubles if "zscore" in c], lambda c: F.abs(c) > 10 + 1e-10),
        "rsi_range": some([c for c in doubles if "_rsi_" in c], lambda c: (c < -1e-8) | (c > 100 + 1e-8)),
        "hurst_range": some([c for c in doubles if "hurst" in c], lambda c: (c < 0) | (c > 1)),
        "valid_with_gap": F.col("is_valid") & F.col("has_data_gap"),
        "valid_in_warmup": F.col("is_valid") & F.col("is_warmup"),
    }
    pivots = F.lit(False)
    for side in ("high", "low"):
        for s in (3, 5):
            if f"ms_is_pivot_{side}_{s}" in names:
                flag = F.coalesce(F.col(f"ms_is_pivot_{side}_{s}"), F.lit(False))
                both = F.col(f"ms_pivot_{side}_timestamp_{s}").isNotNull() & F.col(f"ms_pivot_{side}_age_bars_{s}").isNotNull()
                none = F.col(f"ms_pivot_{side}_timestamp_{s}").isNull() & F.col(f"ms_pivot_{side}_age_bars_{s}").isNull()
                pivots = pivots | F.when(flag, ~both).otherwise(~none)
    rules["pivot_incomplete"] = pivots
    return features.agg(F.count(F.lit(1)).alias("rows"), *[_count(c).alias(k) for k, c in rules.items()])


def warmup_violations(features: DataFrame, keys: tuple[str, ...], warmup: int) -> DataFrame:
    """Series whose number of warm-up rows isn't the smaller of `warmup` and their bars, or isn't a prefix."""
    per = features.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), _count(F.col("is_warmup")).alias("warm"), F.max(F.when(F.col("is_warmup"), F.col("timestamp_utc"))).alias("last"), F.min(F.when(~F.col("is_warmup"), F.col("timestamp_utc"))).alias("first"))
    return per.where((F.col("warm") != F.least(F.col("n"), F.lit(warmup))) | (F.col("last") > F.col("first")))


def check_output(features: DataFrame, registry: FeatureRegistry) -> None:
    row = output_violations(features, registry).first().asDict()
    row.pop("rows")
    if broken := {k: v for k, v in row.items() if v}:
        raise ContractError(f"features break {broken}")


__all__ = ["ContractError", "check_input", "check_output", "input_violations", "output_violations", "warmup_violations"]
