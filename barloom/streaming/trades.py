"""Trades of a stream of bars: entries meet the later bars of their key in an interval join of two streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.expr import safe_div, surrogate_key
from barloom.operators.rolling import S, Series


def trades_stream(bars: DataFrame, entry: Column, exit_: Column, *, stop: float = 0.05, target: float | None = None, days: int = 7, exit_rule: str = "close", late: str = "2 hours", s: Series = S) -> DataFrame:
    """extract_trades() on a stream, one row per entry once its days are over by the watermark: the first later bar that meets the stop, the target or the exit.

    Entries that meet none have null exits; those without any later bar come from the outer side of the join. Both sides have a watermark, so that the state holds the entries and bars
    of the last days only. An entry gathers the bars of its days, of which there are few, and looks through them once.
    """
    if exit_rule not in ("close", "level"):
        raise ValueError("exit_rule is 'close' or 'level'")
    bars = bars.withWatermark(s.ts, late)  # before the filter: bars that are no entries move the entries' watermark on, too
    entries = bars.where(entry).select(s.key, F.col(s.ts).alias("entry_ts"), F.col("close").alias("entry_price"), F.col("low").alias("entry_low"))
    later = bars.select(F.col(s.key).alias("_key"), F.col(s.ts).alias("_ts"), F.col("close").alias("_close"), F.col("high").alias("_high"), F.col("low").alias("_low"), exit_.alias("_exit"))
    within = (F.col(s.key) == F.col("_key")) & (F.col("_ts") > F.col("entry_ts")) & (F.col("_ts") < F.col("entry_ts") + F.expr(f"INTERVAL {days} DAYS"))
    pairs = entries.join(later, within, "leftOuter")
    move = safe_div(F.col("_close") - F.col("entry_price"), "entry_price")
    stop_price = F.col("entry_price") * (1 - stop)
    target_price = F.lit(None).cast("double") if target is None else F.col("entry_price") * (1 + target)
    stopped = move <= -stop if exit_rule == "close" else F.col("_low") <= stop_price
    hit = F.lit(False) if target is None else move >= target if exit_rule == "close" else F.col("_high") >= target_price
    reason = F.when(stopped, "stop").when(hit, "target").when(F.col("_exit"), "signal")
    fill = F.col("_close") if exit_rule == "close" else F.when(stopped, stop_price).when(hit, target_price).otherwise(F.col("_close"))
    bar = F.when(F.col("_ts").isNotNull(), F.struct(F.col("_ts").alias("ts"), F.col("_low").alias("low"), reason.alias("reason"), fill.alias("fill")))
    found = pairs.groupBy(s.key, "entry_ts", "entry_price", "entry_low").agg(F.array_sort(F.collect_list(bar)).alias("_bars"))
    end = F.try_element_at(F.filter("_bars", lambda x: x["reason"].isNotNull()), F.lit(1))
    found = found.withColumn("_end", end)
    worst = F.array_min(F.transform(F.filter("_bars", lambda x: x["ts"] <= F.col("_end.ts")), lambda x: x["low"]))
    out = found.select(s.key, "entry_ts", "entry_price", F.col("_end.ts").alias("exit_ts"), F.col("_end.fill").alias("exit_price"), F.col("_end.reason").alias("reason"), F.when(F.col("_end").isNotNull(), F.least("entry_low", worst)).alias("worst_low"))
    return out.withColumns({
        "trade_id": surrogate_key(s.key, F.unix_seconds("entry_ts")), "realized": safe_div(F.col("exit_price") - F.col("entry_price"), "entry_price"), "drawdown": safe_div(F.col("worst_low") - F.col("entry_price"), "entry_price"),
        "hours": F.floor((F.unix_seconds("exit_ts") - F.unix_seconds("entry_ts")) / 3600),
    })
