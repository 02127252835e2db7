"""Support and resistance levels of daily bars."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.expr import safe_div
from barloom.operators.ema import true_range
from barloom.operators.rolling import S, Series


def average_true_range(bars: DataFrame, n: int = 14, s: Series = S, strict: bool = False) -> DataFrame:
    """atr_n; without strict the first bar's range stands in for its true range."""
    return bars.withColumn("_tr", true_range(s, strict=strict)).withColumn(f"atr_{n}", F.avg("_tr").over(s.rows(n))).drop("_tr")


def swing_points(bars: DataFrame, reach: int = 5, least_atr: float = 0.5, s: Series = S, more: Sequence[str] = ()) -> DataFrame:
    """(key, ts, level, volume, atr_14, and more columns on request) for bars that hold the extreme of `reach` bars either way with an amplitude of least_atr ATRs; from average_true_range()."""
    w = s.ordered.rowsBetween(-reach, reach)
    high, low, need = F.max("high").over(w), F.min("low").over(w), least_atr * F.col("atr_14")
    marked = bars.withColumns({"_top": (F.col("high") == high) & (F.col("high") - low >= need), "_bottom": (F.col("low") == low) & (high - F.col("low") >= need)})
    levels = F.array_compact(F.array(F.when(F.col("_top"), F.col("high")), F.when(F.col("_bottom"), F.col("low"))))
    return marked.withColumn("level", F.explode(levels)).drop("_top", "_bottom").select(s.key, s.ts, "level", "volume", "atr_14", *more)


def level_bins(bars: DataFrame, as_of: Column, *, lookback_days: int = 180, bin_share: float = 0.01, half_life_days: float = 90.0, least_touches: int = 2, s: Series = S) -> DataFrame:
    """(key, level, touches, score, first_touch, last_touch, bin_size): swing points gathered into bins as wide as the larger of 0.75 median ATRs and a share of the last close.

    A touch scores by its volume and halves every half_life_days up to as_of. Only bars up to as_of count.
    """
    rows = average_true_range(bars.where(F.col(s.ts) <= as_of), s=s)
    recent = F.when(F.to_date(s.ts) >= F.date_sub(F.to_date(as_of), lookback_days), F.col("atr_14"))
    # The width belongs to the whole key: a window beside the others, so that the bars are read once.
    whole = Window.partitionBy(s.key)
    rows = rows.withColumns({"_atr": F.percentile(recent, 0.5).over(whole), "_close": F.max_by("close", s.ts).over(whole)})
    points = swing_points(rows, s=s, more=("_atr", "_close")).where(F.col("_atr").isNotNull())
    points = points.withColumn("bin_size", F.greatest(0.75 * F.col("_atr"), bin_share * F.col("_close"), F.lit(1e-9)))
    fade = F.pow(F.lit(0.5), F.datediff(F.to_date(as_of), F.to_date(s.ts)) / half_life_days)
    points = points.withColumns({"_level": F.round(F.col("level") / F.col("bin_size")) * F.col("bin_size"), "_score": (1 + F.ln(F.greatest("volume", F.lit(1.0))) / math.log(10)) * fade})
    found = points.groupBy(s.key, F.col("_level").alias("_at"), "bin_size").agg(F.count("*").alias("touches"), F.sum("_score").alias("score"), F.min(s.ts).alias("first_touch"), F.max(s.ts).alias("last_touch"))
    return found.where(F.col("touches") >= least_touches).withColumnRenamed("_at", "level")


def strongest_levels(bins: DataFrame, key: str = "key") -> DataFrame:
    """Levels whose score reaches a percentile of their key's scores; dispersed or dense scores ask for a higher one (0.5 to 0.8)."""
    whole = Window.partitionBy(key)
    rows = bins.withColumns({
        "_slots": F.round(safe_div(F.max("level").over(whole) - F.min("level").over(whole), F.max("bin_size").over(whole))), "_spread": safe_div(F.stddev_samp("score").over(whole), F.avg("score").over(whole)), "_n": F.count("*").over(whole),
        "_rank": F.row_number().over(whole.orderBy("score")),
    })
    spread, density = F.least(F.lit(2.0), F.col("_spread")), F.least(F.lit(2.0), safe_div("_n", F.nullif("_slots", F.lit(1.0))))
    share = F.greatest(F.lit(0.5), F.least(F.lit(0.8), 0.6 + 0.15 * F.coalesce(spread, F.lit(0.0)) + 0.1 * F.coalesce(density, F.lit(0.0))))
    cut = F.max(F.when(F.col("_rank") == (F.round(share * (F.col("_n") - 1)) + 1).cast("int"), F.col("score"))).over(whole)
    return rows.withColumn("_cut", cut).where(F.col("score") >= F.col("_cut")).select(bins.columns)
