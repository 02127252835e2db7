"""Signals, trades and strategy statistics."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.expr import safe_div, surrogate_key
from barloom.operators.cross import over_time
from barloom.operators.joins import interval_join, next_event
from barloom.operators.rolling import S, Series


def bollinger_indicators(bars: DataFrame, trend: int = 200, s: Series = S, least_volume: float = 1.5, most_rsi: float = 30.0, least_reward: float = 0.04, variant: str = "capitulation") -> DataFrame:
    """Bands, strength, trend and volume ratio, and entry and exit signals.

    "capitulation" needs a price over a rising long average, below the band, on volume, oversold and with a reward to the mean; "uptrend" drops the
    price's place and the reward.
    """
    w = s.ordered
    c = F.col("close")
    before = F.lag("close").over(w)
    df = bars.withColumns({
        "sma_20": F.avg("close").over(s.rows(20)), "std_20": F.stddev_samp("close").over(s.rows(20)), "sma_trend": F.avg("close").over(s.rows(trend)), "_volume": F.avg("volume").over(s.rows(20)),
        "_gain": F.when(c > before, c - before).otherwise(0.0), "_loss": F.when(c < before, before - c).otherwise(0.0),
    })
    gain, loss = F.avg("_gain").over(s.rows(14)), F.avg("_loss").over(s.rows(14))
    df = df.withColumns({
        "rsi_14": F.when(loss == 0, 100.0).otherwise(100 - 100 / (1 + gain / loss)), "sma_trend_before": F.lag("sma_trend", 24).over(w), "band_high": F.col("sma_20") + 2 * F.col("std_20"), "band_low": F.col("sma_20") - 2 * F.col("std_20"),
        "volume_ratio": F.when(F.col("_volume") > 0, F.col("volume") / F.col("_volume")).otherwise(0.0), "reward": F.when(c > 0, (F.col("sma_20") - c) / c).otherwise(0.0),
    })
    signal = (F.col("sma_trend") > F.col("sma_trend_before")) & (c < F.col("band_low")) & (F.col("volume_ratio") > least_volume) & (F.col("rsi_14") < most_rsi)
    if variant == "capitulation":
        signal = (c > F.col("sma_trend")) & signal & (F.col("reward") > least_reward)
    elif variant != "uptrend":
        raise ValueError("variant is 'capitulation' or 'uptrend'")
    return df.withColumns({"signal_entry": signal, "signal_exit": c >= F.col("sma_20")}).drop("_volume", "_gain", "_loss")


def extract_trades(bars: DataFrame, entry: Column, exit_: Column, *, stop: float = 0.05, target: float | None = None, days: int = 7, exit_rule: str = "close", s: Series = S) -> DataFrame:
    """One row per entry that ends within days: the first later bar that meets the exit, the target or the stop.

    exit_rule "close" tests and fills at closes; "level" tests the stop on lows and the target on highs and fills at those levels (the stop first).
    """
    entries = bars.where(entry).select(s.key, F.col(s.ts).alias("entry_ts"), F.col("close").alias("entry_price"), F.col("low").alias("_entry_low"))
    later = bars.select(s.key, s.ts, "close", "high", "low", exit_.alias("_exit"))
    pairs = interval_join(entries, later, key=[s.key], left_ts="entry_ts", right_ts=s.ts, low_seconds=0, high_seconds=days * 86_400 - 1, low_open=True)
    move = safe_div(F.col("close") - F.col("entry_price"), "entry_price")
    stop_price = F.col("entry_price") * (1 - stop)
    target_price = None if target is None else F.col("entry_price") * (1 + target)
    stopped = move <= -stop if exit_rule == "close" else F.col("low") <= stop_price
    hit = F.lit(False) if target is None else move >= target if exit_rule == "close" else F.col("high") >= target_price
    reason = F.when(stopped, "stop").when(hit, "target").when(F.col("_exit"), "signal")
    fill = F.col("close") if exit_rule == "close" else F.when(stopped, stop_price).when(hit, target_price if target is not None else F.lit(None)).otherwise(F.col("close"))
    # The worst low from entry to exit is a running minimum over the same pairs (the entry bar included).
    so_far = Window.partitionBy(s.key, "entry_ts").orderBy(s.ts).rowsBetween(Window.unboundedPreceding, 0)
    marked = pairs.withColumns({"_reason": reason, "_fill": fill, "_worst": F.least("_entry_low", F.min("low").over(so_far))})
    ends = marked.where(F.col("_reason").isNotNull()).groupBy(s.key, "entry_ts", "entry_price").agg(F.min_by(F.struct(F.col(s.ts).alias("exit_ts"), F.col("_fill").alias("exit_price"), F.col("_reason").alias("reason"), F.col("_worst").alias("worst_low")), s.ts).alias("e"))
    out = ends.select(s.key, "entry_ts", "entry_price", "e.*")
    return out.withColumns({
        "trade_id": surrogate_key(s.key, F.unix_seconds("entry_ts")), "realized": safe_div(F.col("exit_price") - F.col("entry_price"), "entry_price"), "drawdown": safe_div(F.col("worst_low") - F.col("entry_price"), "entry_price"),
        "hours": F.floor((F.unix_seconds("exit_ts") - F.unix_seconds("entry_ts")) / 3600),
    })


def trades_to_close(df: DataFrame, s: Series = S, entry: str = "entry", close: str = "close_signal", price: str = "price", at_entry: Sequence[str] = (), largest: Sequence[str] = (), mean: Sequence[str] = ()) -> DataFrame:
    """Trades from each entry flag to the next close flag of its key: realised return, run-up, pullback, drawdown and bars; at_entry columns as the entry has them, and the largest and mean values
    of columns from entry to close.

    Windows give every row's next close and number it; bars between an entry and its close are met by that number, so no row scans its
    key's future. Overlapping entries of one close are separate trades.
    """
    df = next_event(df, F.col(close) == 1, key=[s.key], ts=s.ts, name="close_ts")
    back = Window.partitionBy(s.key).orderBy(F.desc(s.ts))
    rows = df.withColumn("_price_at", F.min(F.when(F.col(close) == 1, F.struct(s.ts, price))).over(back.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("_span", F.count(F.when(F.col(close) == 1, 1)).over(back.rowsBetween(Window.unboundedPreceding, 0)))
    # Extremes from a row to the end of its span: the rows of a span end with the close itself.
    span = Window.partitionBy(s.key, "_span").orderBy(F.desc(s.ts)).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"_max": F.max(price).over(span), "_min": F.min(price).over(span), "_left": F.row_number().over(Window.partitionBy(s.key, "_span").orderBy(F.desc(s.ts))) - 1, **{f"max_{c}": F.max(c).over(span) for c in largest}, **{f"mean_{c}": F.avg(c).over(span) for c in mean}})
    out = rows.where((F.col(entry) == 1) & F.col("close_ts").isNotNull() & (F.col(close) != 1))
    exit_price = F.col(f"_price_at.{price}")
    return out.select(
        s.key, F.col(s.ts).alias("entry_ts"), F.col(price).alias("entry_price"), "close_ts", exit_price.alias("exit_price"), F.col("_left").cast("bigint").alias("bars"), safe_div(exit_price - F.col(price), price).alias("realized"),
        safe_div(F.col("_max") - F.col(price), price).alias("runup"), safe_div(exit_price - F.col("_max"), "_max").alias("pullback"), safe_div(F.col("_min") - F.col(price), price).alias("drawdown"),
        *at_entry, *[f"max_{c}" for c in largest], *[f"mean_{c}" for c in mean],
    )


def trend_regime(df: DataFrame, *, atr_share: tuple[float, float] = (0.01, 0.15), least_month: float = 0.10, volume: tuple[float, float] = (0.5, 5.0), most_atr: float = 0.20, s: Series = S, price: str = "close") -> DataFrame:
    """in_regime, entry and close_signal of a strong trend, from trend_features(): the fast average crosses up in an uptrend with moderate range and volume and a good month; the trend ends when it crosses
    down, the uptrend breaks or the range explodes."""
    w = s.ordered
    fast, slow, share = F.col("ema_21"), F.col("ema_50"), safe_div("atr_14", price)
    before = F.lag("ema_21").over(w), F.lag("ema_50").over(w)
    yes = lambda x: F.coalesce(x, F.lit(False))
    df = df.withColumn("atr_share", share).withColumn("in_regime", yes(F.col("is_uptrend") & F.col("atr_share").between(*atr_share) & (F.col("ret_month") > least_month) & F.col("volume_spike_week").between(*volume)))
    ends = yes((fast < slow) & (before[0] >= before[1])) | yes(~F.col("is_uptrend")) | yes(F.col("atr_share") > most_atr)
    return df.withColumns({"entry": F.when(yes((fast > slow) & (before[0] <= before[1])) & F.col("in_regime"), 1).otherwise(0), "close_signal": F.when(ends, 1).otherwise(0)})


def gain_until_close(df: DataFrame, s: Series = S, entry: str = "entry", close: str = "close_signal", price: str = "close", high: str = "high") -> DataFrame:
    """trade_id counts entries of the key; max_gain is the best high from the entry to its first close flag (or the trade's end) over the entry price."""
    df = df.withColumn("trade_id", F.sum(F.when(F.col(entry) == 1, 1).otherwise(0)).over(s.past)).withColumn("_i", F.row_number().over(s.ordered))
    w = Window.partitionBy(s.key, "trade_id")
    df = df.withColumns({"_close": F.min(F.when(F.col(close) == 1, F.col("_i"))).over(w), "_entry": F.max(F.when(F.col(entry) == 1, F.col(price))).over(w), "_last": F.max("_i").over(w)})
    best = F.max(F.when(F.col("_i") <= F.coalesce("_close", "_last"), F.col(high))).over(w)
    return df.withColumn("max_gain", F.when(F.col("trade_id") > 0, safe_div(best - F.col("_entry"), "_entry") * 100)).drop("_i", "_close", "_entry", "_last")


def combine_strategies(trades: Mapping[str, DataFrame], most: int = 3, s: Series = S) -> DataFrame:
    """At most `most` trades of one entry time, strategies in the order given, then monthly counts, means and the running sum of returns."""
    named = reduce(DataFrame.unionByName, [d.select(s.key, "entry_ts", "realized", F.lit(name).alias("strategy"), F.lit(k).alias("_rank")) for k, (name, d) in enumerate(trades.items())])
    w = Window.partitionBy("entry_ts").orderBy("_rank", s.key)
    taken = named.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= most)
    stats = [x for k, name in enumerate(trades) for x in (F.count_if(F.col("_rank") == k).alias(f"{name}_trades"), F.avg(F.when(F.col("_rank") == k, F.col("realized"))).alias(f"{name}_mean"))]
    months = taken.groupBy(F.date_trunc("month", "entry_ts").cast("date").alias("month")).agg(*stats, F.count("*").alias("trades"), F.sum("realized").alias("total"))
    return months.withColumn("equity", F.sum("total").over(over_time("month").rowsBetween(Window.unboundedPreceding, 0)))


def prior_trade_features(trades: DataFrame, *, key: str = "key", hours: Sequence[int] = (12, 24, 72, 168), half_life_hours: float = 24.0) -> DataFrame:
    """For each trade (key, entry_ts, exit_ts, realized): wins, losses and open trades of its key's entries in the hours before, as known at the entry.

    A trade that hasn't ended by the entry counts as open whatever its result.
    """
    earlier = trades.select(key, F.col("entry_ts").alias("_at"), F.col("exit_ts").alias("_end"), F.col("realized").alias("_result"))
    pairs = interval_join(trades.select(key, "entry_ts").distinct(), earlier, key=[key], left_ts="entry_ts", right_ts="_at", low_seconds=-max(hours) * 3600, high_seconds=-1)
    done = F.col("_end").isNotNull() & (F.col("_end") <= F.col("entry_ts"))
    ago = (F.unix_seconds("entry_ts") - F.unix_seconds("_at")) / 3600
    weight = F.exp(-math.log(2) * ago / half_life_hours)
    out = []
    for h in hours:
        near = ago <= h
        out += [F.count_if(near & done & (F.col("_result") > 0)).alias(f"wins_{h}"), F.count_if(near & done & (F.col("_result") <= 0)).alias(f"losses_{h}"), F.count_if(near & ~done).alias(f"open_{h}")]
    out += [F.min(ago).alias("hours_since"), F.sum(F.when(done & (F.col("_result") > 0), weight).otherwise(0.0)).alias("decayed_wins"), F.sum(F.when(done & (F.col("_result") <= 0), weight).otherwise(0.0)).alias("decayed_losses")]
    found = pairs.groupBy(key, "entry_ts").agg(*out)
    joined = trades.join(found, [key, "entry_ts"], "left").fillna(0, [f"{k}_{h}" for k in ("wins", "losses", "open") for h in hours]).fillna(0.0, ["decayed_wins", "decayed_losses"])
    return joined.withColumns({f"win_rate_{h}": safe_div(f"wins_{h}", F.col(f"wins_{h}") + F.col(f"losses_{h}")) for h in hours})


def fills_blotter(log: DataFrame) -> DataFrame:
    """Admitted decisions with a fill, one row each, signed by side."""
    side = F.when(F.col("fill_side") == "buy", 1).when(F.col("fill_side") == "sell", -1)
    return log.where(F.col("admitted") & side.isNotNull()).withColumns({"side": side, "signed_usd": side * F.col("fill_size_usd"), "fee_usd": F.col("fill_size_usd") * F.col("fill_fee_bps") / 10_000})


def activity_report(log: DataFrame, unit: str = "day") -> DataFrame:
    """Decisions, admissions, buys, sells and distinct tokens per model and cycle."""
    buy, sell = F.col("fill_side") == "buy", F.col("fill_side") == "sell"
    return log.groupBy("model_id", F.date_trunc(unit, "ts").alias("cycle")).agg(
        F.count("*").alias("decisions"), F.count_if("admitted").alias("admitted"), F.count_if(F.col("admitted") & buy).alias("buys"), F.count_if(F.col("admitted") & sell).alias("sells"),
        F.countDistinct("token").alias("tokens"), F.countDistinct(F.when(F.col("admitted"), F.col("token"))).alias("traded_tokens"),
    )


def ledger_curve(log: DataFrame, unit: str = "day") -> DataFrame:
    """Net cash flow per model and cycle and its running sum."""
    flows = fills_blotter(log).groupBy("model_id", F.date_trunc(unit, "ts").alias("cycle")).agg((-F.sum("signed_usd") - F.sum("fee_usd")).alias("flow"), F.count("*").alias("fills"))
    return flows.withColumn("cash", F.sum("flow").over(Window.partitionBy("model_id").orderBy("cycle").rowsBetween(Window.unboundedPreceding, 0)))
