"""Forward paths, first-passage and trend labels, profit matrices and training sets."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.expr import null_if_zero, safe_corr, safe_div, safe_ln
from barloom.operators.joins import interval_join, next_event
from barloom.operators.rolling import S, Series

#: Sentinel of a threshold that is never met.
NEVER = 200
#: Thresholds of first passage.
UP = (0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50, 0.75, 1.00, 2.00, 5.00)
DOWN = (0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50)


def forward_paths(bars: DataFrame, entry: Column, hours: int = 72, until: str | None = None, s: Series = S, price: str = "price") -> DataFrame:
    """(key, entry_ts, h, price) for h = 0..hours after each entry that has that many hours left (to `until`, or to the key's last bar)."""
    last = F.max(s.ts).over(Window.partitionBy(s.key)) if until is None else F.col(until)
    entries = bars.withColumn("_last", last).where(entry & (F.col(s.ts) + F.expr(f"INTERVAL {hours} HOURS") <= F.col("_last"))).select(s.key, F.col(s.ts).alias("entry_ts"))
    pairs = interval_join(entries, bars.select(s.key, s.ts, price), key=[s.key], left_ts="entry_ts", right_ts=s.ts, low_seconds=0, high_seconds=hours * 3600)
    return pairs.select(s.key, "entry_ts", F.floor((F.unix_seconds(s.ts) - F.unix_seconds("entry_ts")) / 3600).alias("h"), F.col(price).alias("price"))


def _name(prefix: str, x: float) -> str:
    return f"{prefix}_{round(x * 100)}"


def path_summary(paths: DataFrame, hours: int = 72, checkpoints: Sequence[int] = (8, 24, 48, 72), up: Sequence[float] = UP, down: Sequence[float] = DOWN, key: str = "key", exact: bool = True, fill: float | None = 0.0) -> DataFrame:
    """One row per entry: returns at checkpoints, hours to thresholds, extremes and their hours, volatility, tails, trend and segment means.

    fill replaces null returns and means (None leaves them null).
    """
    w = Window.partitionBy(key, "entry_ts")
    ordered = w.orderBy("h")
    before = F.lag("price").over(ordered)
    seq = paths.withColumns({
        "price0": F.max(F.when(F.col("h") == 0, F.col("price"))).over(w), "logret": F.when((F.col("price") > 0) & (before > 0), F.ln(F.col("price") / before)),
        "_peak": F.max("price").over(ordered.rowsBetween(Window.unboundedPreceding, 0)), "_log": safe_ln("price"), "_h": F.col("h").cast("double"),
    }).withColumn("cumret", safe_div("price", "price0") - 1)
    filled = (lambda x: x) if fill is None else (lambda x: F.coalesce(x, F.lit(fill)))
    r, h = F.col("cumret"), F.col("h")
    first = lambda cond: F.coalesce(F.min(F.when(cond, h)), F.lit(NEVER)).cast("bigint")
    edges = (0, *checkpoints)
    n_pos, n_all = F.count_if(F.col("logret") > 0), F.count("logret")
    p95 = F.percentile(F.abs("logret"), 0.95) if exact else F.percentile_approx(F.abs("logret"), 0.95, 10_000)
    cov = F.covar_samp("_log", "_h")
    out = [F.count("*").alias("n_points"), F.max("h").alias("max_h"), F.max("price0").alias("price0")]
    out += [filled(F.max(F.when(h == c, r))).alias(f"ret_{c}h") for c in checkpoints]
    out += [first(r >= x).alias(_name("t_up", x)) for x in up] + [first(r <= -x).alias(_name("t_down", x)) for x in down]
    out += [
        F.max_by("h", F.struct("price", -h)).alias("peak_h"), F.min_by("h", F.struct("price", h)).alias("trough_h"), filled(F.max(r)).alias("max_gain"), filled(F.min(safe_div("price", "_peak") - 1)).alias("max_drawdown"),
        (F.sqrt(F.sum(F.coalesce(F.col("logret") * F.col("logret"), F.lit(0.0)))) * math.sqrt(24)).alias("rv"), filled(F.stddev_samp("logret")).alias("std_logret"), filled(F.avg("logret")).alias("mean_logret"),
        filled(p95).alias("p95_abs_logret"), filled(safe_div(n_pos, n_all)).alias("share_up"), filled(safe_div(F.avg("logret"), null_if_zero(F.stddev_samp("logret"))) * math.sqrt(24)).alias("sharpe"),
        filled(safe_div(cov, null_if_zero(F.var_samp(F.when(F.col("_log").isNotNull(), F.col("_h")))))).alias("log_slope"), filled(F.pow(safe_corr("_h", "_log"), F.lit(2.0))).alias("log_r2"), filled(F.avg(r)).alias("mean_cumret"),
    ]
    out += [filled(F.avg(F.when(h.between(a, b), r))).alias(f"mean_cumret_{a}_{b}h") for a, b in zip(edges, edges[1:])]
    full = F.when((F.col("n_points") >= hours + 1) & (F.col("max_h") == hours), 1).otherwise(0)
    return seq.groupBy(key, "entry_ts").agg(*out).withColumn("is_full", full)


def first_passage_label(summary: DataFrame, up: float, down: float, cap: int = 75, name: str = "label") -> DataFrame:
    """1 where the rise comes before the fall and before cap hours, else 0; hours over cap count as cap."""
    t_up, t_down = (F.least(F.coalesce(F.col(_name(p, x)), F.lit(cap)), F.lit(cap)) for p, x in (("t_up", up), ("t_down", down)))
    return summary.withColumn(name, F.when((t_up < cap) & (t_up < t_down), 1).otherwise(0))


def trend_labels(paths: DataFrame, horizons: Sequence[tuple[str, int, float, float, float]] = (("entry", 8, 0.02, 0.5, -0.02), ("manage", 72, 0.05, 0.5, -0.05)), key: str = "key") -> DataFrame:
    """Per entry and horizon (name, hours, least return, least R2, worst excursion): forward log return, R2, excursions and a label of 1, -1 or 0.

    Excursions and R2 are over the hours 0..H of the path; an entry without a full horizon has null metrics and label 0.
    """
    w = Window.partitionBy(key, "entry_ts")
    p = paths.withColumns({"_log": safe_ln("price"), "_h": F.col("h").cast("double"), "_p0": F.max(F.when(F.col("h") == 0, F.col("price"))).over(w)})
    out = [F.max("_p0").alias("price0")]
    for name, hours, *_ in horizons:
        inside = F.col("h") <= hours
        y, x = F.when(inside, F.col("_log")), F.when(inside & F.col("_log").isNotNull(), F.col("_h"))
        full = F.count_if(inside) >= hours + 1
        move = lambda f: F.when(full & (F.max("_p0") > 0), safe_ln(safe_div(f, F.max("_p0"))))  # noqa: B023, E731
        out += [
            full.cast("int").alias(f"full_{name}"), move(F.max(F.when(F.col("h") == hours, F.col("price")))).alias(f"fwd_{name}"), F.when(full, F.pow(safe_corr(x, y), F.lit(2.0))).alias(f"r2_{name}"),
            move(F.max(F.when(inside, F.col("price")))).alias(f"mfe_{name}"), move(F.min(F.when(inside, F.col("price")))).alias(f"mae_{name}"),
        ]
    found = p.groupBy(key, "entry_ts").agg(*out)
    for name, _, least, r2, worst in horizons:
        fwd, clean = F.col(f"fwd_{name}"), F.col(f"r2_{name}") >= r2
        found = found.withColumn(f"label_{name}", F.when((fwd >= least) & clean & (F.col(f"mae_{name}") >= worst), 1).when((fwd <= -least) & clean & (F.col(f"mfe_{name}") <= -worst), -1).otherwise(0))
    return found


def profit_matrix(summary: DataFrame, up: Sequence[float] = UP[:12], down: Sequence[float] = DOWN) -> DataFrame:
    """(up_threshold, one column for each fall): entries that rise before they fall, for every pair of thresholds."""
    ups = F.array(*[F.struct(F.lit(round(x * 100)).alias("up_threshold"), F.col(_name("t_up", x)).alias("t_up")) for x in up])
    downs = F.array(*[F.struct(F.lit(round(x * 100)).alias("down_threshold"), F.col(_name("t_down", x)).alias("t_down")) for x in down])
    pairs = summary.select(F.explode(ups).alias("u"), downs.alias("downs")).select("u.*", F.explode("downs").alias("d")).select("up_threshold", "t_up", "d.*")
    won = ((F.col("t_up") < F.col("t_down")) & (F.col("t_up") < NEVER)).cast("bigint")
    found = pairs.withColumn("won", won).groupBy("up_threshold").pivot("down_threshold", [round(x * 100) for x in down]).sum("won")
    return found.select("up_threshold", *[F.col(str(round(x * 100))).alias(f"before_down_{round(x * 100)}") for x in down])


def training_set(features: DataFrame, labels: DataFrame, *, key: str = "key", ts: str = "ts", label_ts: str = "entry_ts", complete: Column | None = None, blocks: Iterable[tuple[DataFrame, Sequence[str]]] = (), tie: Sequence[str] = ()) -> DataFrame:
    """Features with one label row for each (key, time), complete rows only, and left-joined blocks."""
    w = Window.partitionBy(key, label_ts).orderBy(*(tie or labels.columns))
    one = labels.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n").withColumnRenamed(label_ts, ts)
    rows = features.join(one, [key, ts])
    rows = rows if complete is None else rows.where(complete)
    return reduce(lambda d, b: d.join(b[0], list(b[1]), "left"), blocks, rows)


def target_before_stop(entries: DataFrame, bars: DataFrame, target: float, stop: float, hours: int, *, key: str = "key", entry_ts: str = "entry_ts", entry_price: str = "entry_price", ts: str = "ts") -> DataFrame:
    """label 1 where a later bar's high meets the target before any bar's low meets the stop, by bar order; a bar that meets both counts as stopped."""
    pairs = interval_join(entries.select(key, entry_ts, entry_price), bars.select(key, ts, "high", "low"), key=[key], left_ts=entry_ts, right_ts=ts, low_seconds=0, high_seconds=hours * 3600, low_open=True)
    seq = pairs.withColumn("_i", F.row_number().over(Window.partitionBy(key, entry_ts).orderBy(ts)))
    first = lambda cond: F.min(F.when(cond, F.col("_i")))
    found = seq.groupBy(key, entry_ts).agg(first(F.col("high") >= F.col(entry_price) * (1 + target)).alias("target_bar"), first(F.col("low") <= F.col(entry_price) * (1 - stop)).alias("stop_bar"))
    out = entries.join(found, [key, entry_ts], "left")
    won = F.col("target_bar").isNotNull() & (F.col("stop_bar").isNull() | (F.col("target_bar") < F.col("stop_bar")))
    return out.withColumn("label", F.when(won, 1).otherwise(0))


def target_before_close(df: DataFrame, target: float, stop: float, hours: int, *, s: Series = S, entry: str = "entry", close: str = "close_signal", price: str = "price") -> DataFrame:
    """(key, entry_ts, entry_price, next_close_ts, boundary_ts, gain_ts, loss_ts, label): the first entry flag after each close flag, up to the next close or `hours`, whichever is first.

    label 1 where the price gains the target before it loses the stop, both at once counting as a gain. Entries that follow an entry before any close are suppressed.
    """
    closed = F.col(close) == 1
    rows = next_event(df.withColumn("_closed", F.max(F.when(closed, F.col(s.ts))).over(s.past)), closed, key=[s.key], ts=s.ts, name="next_close_ts")
    first = F.row_number().over(Window.partitionBy(s.key, "_closed").orderBy(s.ts)) == 1
    entries = rows.where(F.col(entry) == 1).withColumn("_first", first).where("_first").select(s.key, F.col(s.ts).alias("entry_ts"), F.col(price).alias("entry_price"), "next_close_ts")
    entries = entries.withColumn("boundary_ts", F.least("next_close_ts", F.col("entry_ts") + F.expr(f"INTERVAL {hours} HOURS")))
    pairs = interval_join(entries, df.select(s.key, s.ts, price), key=[s.key], left_ts="entry_ts", right_ts=s.ts, low_seconds=0, high_seconds=hours * 3600).where(F.col(s.ts) <= F.col("boundary_ts"))
    hit = lambda cond: F.min(F.when(cond, F.col(s.ts)))
    found = pairs.groupBy(s.key, "entry_ts", "entry_price", "next_close_ts", "boundary_ts").agg(hit(F.col(price) >= F.col("entry_price") * (1 + target)).alias("gain_ts"), hit(F.col(price) <= F.col("entry_price") * (1 - stop)).alias("loss_ts"))
    won = F.col("gain_ts").isNotNull() & (F.col("loss_ts").isNull() | (F.col("gain_ts") <= F.col("loss_ts")))
    return found.withColumn("label", F.when(won, 1).otherwise(0))


def acquisition_peaks(bars: DataFrame, acquired: DataFrame, days: int = 7, least: float = 0.25, *, key: str = "key", ts: str = "ts", price: str = "price") -> DataFrame:
    """(key, acquired_ts, acquired_price, max_price, gain, label_peak): the highest price in the days after each acquisition, and whether it gains at least `least`."""
    pairs = interval_join(acquired.select(key, "acquired_ts", "acquired_price"), bars.where(F.col(price).isNotNull()).select(key, ts, price), key=[key], left_ts="acquired_ts", right_ts=ts, low_seconds=0, high_seconds=days * 86_400)
    found = pairs.groupBy(key, "acquired_ts", "acquired_price").agg(F.max(price).alias("max_price"))
    found = found.withColumn("gain", safe_div(F.col("max_price") - F.col("acquired_price"), "acquired_price"))
    return found.withColumn("label_peak", F.when(F.col("gain") >= least, 1).otherwise(0))


def around_acquisition(bars: DataFrame, acquired: DataFrame, days: int = 7, *, key: str = "key", ts: str = "ts", price: str = "price") -> DataFrame:
    """Bars within days of each acquisition (key, acquired_ts), with the side and the price change; the change divides by the later of the two prices."""
    pairs = interval_join(acquired, bars.select(key, ts, price), key=[key], left_ts="acquired_ts", right_ts=ts, low_seconds=-days * 86_400, high_seconds=days * 86_400)
    w = Window.partitionBy(key, "acquired_ts")
    pairs = pairs.withColumn("_p0", F.max_by(price, F.when(F.col(ts) <= F.col("acquired_ts"), F.col(ts))).over(w))
    side = F.when(F.col(ts) < F.col("acquired_ts"), "before").when(F.col(ts) > F.col("acquired_ts"), "after").otherwise("at")
    later = F.when(F.col(ts) >= F.col("acquired_ts"), F.col(price)).otherwise(F.col("_p0"))
    earlier = F.when(F.col(ts) >= F.col("acquired_ts"), F.col("_p0")).otherwise(F.col(price))
    return pairs.withColumns({"side": side, "change": safe_div(later - earlier, later)}).drop("_p0")
