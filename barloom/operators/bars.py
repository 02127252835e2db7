"""Bars: resampling, regular grids, gaps, market cap, pivot levels and clean universes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.expr import zero
from barloom.operators.joins import interval_join


def resample_bars(ticks: DataFrame, unit: str = "hour", *, key: str = "key", ts: str = "ts", price: str = "price", volume: str = "volume", tie: Sequence[str] = ()) -> DataFrame:
    """(key, ts of the bucket, open, high, low, close, volume); tie columns order ticks of one instant."""
    order = F.struct(ts, *tie)
    return (
        ticks.groupBy(key, F.date_trunc(unit, ts).alias("_bucket"))
        .agg(F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, order).alias("close"), F.sum(volume).alias("volume"))
        .withColumnRenamed("_bucket", ts)
    )


def hourly_mean(ticks: DataFrame, *, key: str = "key", ts: str = "ts", price: str = "price", volume: str = "volume") -> DataFrame:
    """Mean price and largest volume of every hour; prices that aren't positive are left out."""
    valid = ticks.where(F.col(ts).isNotNull() & (F.col(price) > 0))
    return valid.groupBy(key, F.date_trunc("hour", ts).alias("_hour")).agg(F.avg(price).alias(price), F.max(volume).alias(volume)).withColumnRenamed("_hour", ts)


def fill_grid(bars: DataFrame, step: str = "1 hour", *, key: str = "key", ts: str = "ts", ffill: Sequence[str] = ("price",), zeros: Sequence[str] = ("volume",)) -> DataFrame:
    """One row for every step from a key's first to its last bar: ffill columns carried on, zeros columns 0 where no bar was. Bars that are off these steps go; step has a fixed length.

    Each bar gives its own row and those up to the next bar, so that the bars are read once and nothing is joined.
    """
    length = F.expr(f"unix_micros(timestamp_micros(0) + interval {step})")
    ordered = Window.partitionBy(key).orderBy(ts)
    past = ordered.rowsBetween(Window.unboundedPreceding, 0)
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rows = bars.where(F.col(ts).isNotNull()).select(key, ts, *ffill, *zeros).withColumn("_first", F.min(ts).over(past)).where((micros(ts) - micros("_first")) % length == 0)
    rows = rows.withColumns({"_next": F.lead(ts).over(ordered), **{c: F.last(c, ignorenulls=True).over(past) for c in ffill}})
    steps = F.greatest(F.coalesce(F.floor((micros("_next") - micros(ts)) / length), F.lit(1)), F.lit(1)).cast("int")
    rows = rows.withColumn("_k", F.explode(F.sequence(F.lit(0), steps - 1)))
    return rows.select(key, F.expr(f"`{ts}` + _k * interval {step}").alias(ts), *ffill, *[F.when(F.col("_k") == 0, zero(c)).otherwise(F.lit(0.0)).alias(c) for c in zeros])


def last_in_bucket(ticks: DataFrame, unit: str = "hour", *, key: str = "key", ts: str = "ts", tie: Sequence[str] = ()) -> DataFrame:
    """The latest row of every (key, bucket), with the bucket as ts."""
    w = Window.partitionBy(key, F.date_trunc(unit, ts)).orderBy(F.desc(ts), *[F.desc(c) for c in tie])
    return ticks.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n").withColumn(ts, F.date_trunc(unit, ts))


def find_gaps(bars: DataFrame, step_seconds: int = 3600, *, key: str = "key", ts: str = "ts") -> DataFrame:
    """(key, gap_start, gap_end, gap_steps, missing) for neighbours that are more than a step apart."""
    w = Window.partitionBy(key).orderBy(ts)
    seen = bars.select(key, ts).distinct().withColumn("gap_start", F.lag(ts).over(w))
    steps = F.floor((F.unix_seconds(ts) - F.unix_seconds("gap_start")) / step_seconds)
    return seen.withColumn("gap_steps", steps).where("gap_steps > 1").select(key, "gap_start", F.col(ts).alias("gap_end"), "gap_steps", (F.col("gap_steps") - 1).alias("missing"))


def with_market_cap(bars: DataFrame, supply: DataFrame, *, key: str = "key", price: str = "price", supply_col: str = "supply", stored: str = "stored_mktcap", reference: Sequence[str] = ()) -> DataFrame:
    """mktcap: price x supply where the supply is positive, else the stored one; null for reference keys."""
    facts = supply.groupBy(key).agg(F.max(supply_col).alias(supply_col), F.max(stored).alias(stored))
    cap = F.coalesce(F.when(F.col(supply_col) > 0, F.col(price) * F.col(supply_col)), F.col(stored))
    out = bars.join(facts, key, "left")
    return out.withColumn("mktcap", F.when(~F.col(key).isin(list(reference)), cap) if reference else cap).drop(supply_col, stored)


def pivot_levels(bars: DataFrame, *, high: str = "high", low: str = "low", close: str = "close") -> DataFrame:
    """Classic pivot, two resistances and two supports of every bar."""
    h, lo, c = F.col(high), F.col(low), F.col(close)
    p = (h + lo + c) / 3
    return bars.withColumns({"pivot": p, "r1": 2 * p - lo, "s1": 2 * p - h, "r2": p + (h - lo), "s2": p - (h - lo)})


def clean_universe(bars: DataFrame, gaps: DataFrame, excluded: DataFrame, *, key: str = "key") -> DataFrame:
    """Bars of keys that have no gap and aren't excluded."""
    return bars.join(gaps.select(key), key, "left_anti").join(excluded.select(key), key, "left_anti")


def anchored_windows(bars: DataFrame, *, anchor_hour: int = 5, min_cap: float = 0.0, hours: int = 1680, key: str = "key", ts: str = "ts", cap: str = "mktcap", distinct: bool = False) -> DataFrame:
    """Rows in the `hours` up to an anchor: a bar at exactly anchor_hour whose cap suffices. A row repeats for every anchor unless distinct."""
    at = (F.hour(ts) == anchor_hour) & (F.minute(ts) == 0) & (F.second(ts) == 0)
    if distinct:  # an anchor at the row's time or later, within the hours: one window, no pairs
        ahead = Window.partitionBy(key).orderBy(F.unix_seconds(ts)).rangeBetween(0, hours * 3600 - 1)
        return bars.withColumn("_anchored", F.max(at & (F.col(cap) >= min_cap)).over(ahead)).where("_anchored").drop("_anchored").distinct()
    anchors = bars.where(at & (F.col(cap) >= min_cap)).select(key, F.col(ts).alias("anchor"))
    pairs = interval_join(anchors, bars, key=[key], left_ts="anchor", right_ts=ts, low_seconds=-hours * 3600, high_seconds=0, low_open=True)
    return pairs.select(*bars.columns, "anchor")


def wallet_token_filter(holdings: DataFrame, *, min_wallets: int, active_days: int, as_of: Column, token: str = "token", wallet: str = "wallet", last: str = "last_ts") -> DataFrame:
    """Tokens held by at least min_wallets distinct wallets, with an acquisition in the active_days before as_of."""
    held = holdings.groupBy(token).agg(F.countDistinct(wallet).alias("wallets"), F.max(last).alias("latest"))
    return held.where((F.col("wallets") >= min_wallets) & (F.col("latest") >= as_of - F.expr(f"INTERVAL {active_days} DAYS")))


def exclude_pegged(bars: DataFrame, *, level: float = 1.0, tolerance: float = 0.05, key: str = "key", price: str = "close", ts: str = "ts", as_of: Column | None = None) -> DataFrame:
    """Bars of keys whose mean price isn't within tolerance of level; with as_of only bars up to then count for the mean."""
    seen = bars if as_of is None else bars.where(F.col(ts) <= as_of)
    pegged = seen.groupBy(key).agg(F.avg(price).alias("_m")).where(F.abs(F.col("_m") - level) <= tolerance).select(key)
    return bars.join(pegged, key, "left_anti")


def histogram(df: DataFrame, column: str, width: float, low: float, high: float) -> DataFrame:
    """(bucket, n, label) of values clamped to [low, high] in steps of width; nulls are left out."""
    held = F.least(F.greatest(F.col(column), F.lit(low)), F.lit(high))
    bucket = (F.floor(held / width) * width).cast("double")
    counts = df.where(F.col(column).isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"))
    return counts.withColumn("label", F.concat(F.format_string("%.1f", "bucket"), F.lit(".."), F.format_string("%.1f", F.col("bucket") + width)))


