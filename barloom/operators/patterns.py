"""Price-pattern detectors and asset classes to exclude."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.expr import null_if_zero, safe_div, safe_ln, strict_greatest, strict_least
from barloom.operators.rolling import S, Series


def distribution_features(bars: DataFrame, *, since: Column | None = None, least_rows: int = 500, s: Series = S, exact: bool = True) -> DataFrame:
    """One row per key with enough bars: distribution of closes, lows, volumes, candle shapes and moves, and ratios of them."""
    rows = bars if since is None else bars.where(F.col(s.ts) >= since)
    span = F.col("high") - F.col("low")
    before, green = F.lag("close").over(s.ordered), F.col("close") >= F.col("open")
    rows = rows.withColumns({"span": span, "body": F.abs(F.col("close") - F.col("open")), "green": green, "move": safe_div(F.col("close") - before, before)})
    rows = rows.withColumns({"body_share": safe_div("body", null_if_zero("span")), "turn": F.when(F.lag("green").over(s.ordered).isNotNull(), F.when(F.col("green") != F.lag("green").over(s.ordered), 1.0).otherwise(0.0))})
    q = (lambda x, p: F.percentile(x, p)) if exact else (lambda x, p: F.percentile_approx(x, p, 10_000))
    share = lambda cond: F.avg(F.when(cond, 1.0).otherwise(0.0))
    found = rows.groupBy(s.key).agg(
        F.count("*").alias("n"), q("close", 0.5).alias("median_close"), F.stddev_samp("close").alias("std_close"), F.min("close").alias("min_close"), F.max("close").alias("max_close"), q("close", 0.01).alias("p01_close"), q("close", 0.99).alias("p99_close"),
        q("low", 0.01).alias("p01_low"), F.min("low").alias("min_low"), F.max("volume").alias("max_volume"), q("volume", 0.5).alias("median_volume"), share(F.col("volume").isNull() | (F.col("volume") == 0)).alias("zero_volume_share"),
        F.avg("span").alias("mean_span"), F.avg("body_share").alias("mean_body_share"), q("body_share", 0.5).alias("median_body_share"), share((F.col("span") > 0) & (F.col("body_share") <= 0.15)).alias("wick_share"),
        q("span", 0.05).alias("p05_span"), q("span", 0.95).alias("p95_span"), share(F.col("green")).alias("green_share"), share(F.col("move").isNull() | (F.abs("move") < 0.002)).alias("tiny_move_share"),
        share(F.abs("move") > 0.3).alias("big_move_share"), F.avg("turn").alias("turn_share"), F.max(s.ts).alias("last_ts"),
    )
    return found.where(F.col("n") >= least_rows).withColumns({
        "close_vol_ratio": safe_div("std_close", "median_close"), "span_ratio": safe_div("mean_span", "median_close"), "p01_low_ratio": safe_div("p01_low", "median_close"), "max_to_min": safe_div("max_close", "min_close"),
        "p01_to_max": safe_div("p01_close", "max_close"), "p01_to_p99": safe_div("p01_close", "p99_close"), "volume_peak_ratio": safe_div("max_volume", null_if_zero("median_volume")), "span_spread": safe_div("p95_span", null_if_zero("p05_span")),
    })


# Thresholds of the patterns, as (feature, relation, bound).
PATTERNS: Mapping[str, tuple[tuple[str, str, float], ...]] = {
    "decay": (("max_to_min", ">=", 10.0), ("green_share", "<=", 0.35), ("p01_to_max", "<=", 0.15)),
    "flash": (("p01_low_ratio", "<=", 0.10), ("p01_to_p99", ">=", 0.40)),
    "frozen": (("close_vol_ratio", "<=", 0.02), ("tiny_move_share", ">=", 0.70)),
    "micro": (("turn_share", ">=", 0.60), ("median_body_share", "<=", 0.10), ("span_spread", "<=", 5.0), ("close_vol_ratio", ">=", 0.01), ("close_vol_ratio", "<=", 0.20)),
    "park": (("max_to_min", ">=", 8.0), ("close_vol_ratio", "<=", 0.05), ("green_share", ">=", 0.60)),
    "pump": (("max_to_min", ">=", 15.0), ("big_move_share", ">=", 0.02), ("p01_to_max", "<=", 0.20)),
    "side": (("max_to_min", ">=", 5.0),),
    "stable": (("close_vol_ratio", "<=", 0.01), ("max_to_min", "<=", 1.05)),
    "thin": (("span_ratio", ">=", 0.30), ("zero_volume_share", ">=", 0.40)),
    "wash": (("close_vol_ratio", "<=", 0.03), ("volume_peak_ratio", ">=", 10.0), ("zero_volume_share", "<=", 0.10)),
    "wicks": (("wick_share", ">=", 0.70), ("mean_body_share", "<=", 0.20), ("span_ratio", ">=", 0.30)),
}
ONE_SIDED = (0.15, 0.85)


def pattern_flags(features: DataFrame, patterns: Mapping[str, tuple[tuple[str, str, float], ...]] = PATTERNS) -> DataFrame:
    """One boolean column per pattern, in one pass; unknown features count as no."""
    out = {}
    for name, tests in patterns.items():
        flag = F.lit(True)
        for feature, relation, bound in tests:
            flag = flag & (F.col(feature) >= bound if relation == ">=" else F.col(feature) <= bound)
        if name == "side":
            flag = flag & ((F.col("green_share") >= ONE_SIDED[1]) | (F.col("green_share") <= ONE_SIDED[0]))
        out[name] = F.coalesce(flag, F.lit(False))
    return features.withColumns(out)


def detections(flags: DataFrame, key: str = "key", patterns: Mapping[str, object] = PATTERNS) -> DataFrame:
    """(key, pattern) for every flag that holds."""
    return flags.select(key, F.explode(F.array_compact(F.array(*[F.when(F.col(p), F.lit(p)) for p in patterns]))).alias("pattern"))


def hardened_exclusions(found: DataFrame, manual: DataFrame, least_days: int = 90, key: str = "key") -> DataFrame:
    """(key, pattern) detected over more than least_days (column window_start), and the manual list as manual:notes."""
    lasting = found.groupBy(key, "pattern").agg(F.datediff(F.max("window_start"), F.min("window_start")).alias("_days")).where(F.col("_days") > least_days).select(key, "pattern")
    return lasting.unionByName(manual.select(key, F.concat(F.lit("manual:"), "notes").alias("pattern")))


def flag_rollup(found: DataFrame, key: str = "key") -> DataFrame:
    """Per key: one flag per detection column, true if ever true, and when it was last processed."""
    flags = [c for c, t in found.dtypes if t == "boolean"]
    return found.groupBy(key).agg(*[F.max(c).alias(c) for c in flags], F.max("processed_at").alias("processed_at"), *[F.max_by(c, "processed_at").alias(f"latest_{c}") for c in flags])


def wrapped_assets(bars: DataFrame, references: list[str], *, least_rows: int = 200, most_std: float = 0.01, ratio: tuple[float, float] = (0.5, 3.0), s: Series = S, price: str = "price") -> DataFrame:
    """(key, reference) whose price is a constant multiple of a reference's, measured for each reference alone."""
    live = bars.where(F.col(price) > 0)
    refs = live.where(F.col(s.key).isin(references)).select(F.col(s.key).alias("reference"), s.ts, F.col(price).alias("_ref"))
    both = live.join(refs, s.ts).where(F.col(s.key) != F.col("reference"))
    r = F.col(price) / F.col("_ref")
    stats = both.groupBy(s.key, "reference").agg(F.count("*").alias("n"), F.stddev_samp(F.ln(r)).alias("ratio_std"), F.avg(r).alias("mean_ratio"))
    return stats.where((F.col("n") >= least_rows) & (F.col("ratio_std") < most_std) & F.col("mean_ratio").between(*ratio))


def pegged_assets(bars: DataFrame, *, least_rows: int = 200, most_vol_pct: float = 0.10, s: Series = S, price: str = "price") -> DataFrame:
    """Keys whose hourly log returns hardly move (deviation in percent)."""
    live = bars.where(F.col(price) > 0)
    moves = live.withColumn("_r", safe_ln(safe_div(price, F.lag(price).over(s.ordered))))
    stats = moves.groupBy(s.key).agg(F.count("*").alias("n"), (F.stddev_samp("_r") * 100).alias("vol_pct"))
    return stats.where((F.col("n") >= least_rows) & (F.col("vol_pct") < most_vol_pct))


def wash_traded(bars: DataFrame, *, most_ratio: float = 3.0, s: Series = S, volume: str = "dollar_volume", cap: str = "mktcap") -> DataFrame:
    """Keys whose median dollar volume is more than most_ratio times their median market cap."""
    stats = bars.groupBy(s.key).agg(F.percentile(volume, 0.5).alias("median_volume"), F.percentile(cap, 0.5).alias("median_cap"))
    return stats.where(F.col("median_volume") > most_ratio * F.col("median_cap"))


def wick_shares(bars: DataFrame) -> DataFrame:
    """Upper and lower wick shares of the span."""
    span = null_if_zero(F.col("high") - F.col("low"))
    return bars.withColumns({"upper_share": safe_div(F.col("high") - strict_greatest("open", "close"), span), "lower_share": safe_div(strict_least("open", "close") - F.col("low"), span)})
