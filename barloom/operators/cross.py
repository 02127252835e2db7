"""Cross-sections: all keys at one time, reference series, and the serving contract."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.expr import null_if_zero, prefixed, safe_div
from barloom.operators.frames import Frame, add_frames
from barloom.operators.rolling import Series


def median(x: str | Column, exact: bool = True) -> Column:
    """Exact (interpolated) or approximate median."""
    return F.percentile(x, 0.5) if exact else F.percentile_approx(x, 0.5, 10_000)


def snap(x: Column, least: float = 1e-12) -> Column:
    """Values closer to zero than least are zero."""
    return F.when(F.abs(x) < least, 0.0).otherwise(x)


def universe_stats(df: DataFrame, ts: str = "ts", short: str = "cumret_24", long: str = "cumret_168", drawdown: str = "dist_high_168", deep: float = -0.1, exact: bool = True) -> DataFrame:
    """One row per time: count, median, mean and dispersion of returns, and shares of keys that rise, stand above averages (by more than rounding) or lie deep below their high."""
    share = lambda cond: F.avg(F.when(cond, 1.0).otherwise(0.0))
    return df.groupBy(ts).agg(
        F.count("*").alias("univ_n"), snap(median(short, exact)).alias("univ_median_short"), snap(F.avg(short)).alias("univ_mean_short"), snap(F.stddev_samp(short)).alias("univ_dispersion_short"), snap(median(long, exact)).alias("univ_median_long"),
        share(snap(F.col(short)) > 0).alias("univ_share_up"), share(snap(F.col("dist_sma_24")) > 0).alias("univ_share_above_24"), share(snap(F.col("dist_sma_168")) > 0).alias("univ_share_above_168"),
        share(F.col(drawdown) < deep).alias("univ_share_deep"), snap(median("rv_24", exact)).alias("univ_median_rv"),
    )


def over_time(ts: str = "ts") -> WindowSpec:
    """Window over a table with one row per time; one partition, since that table is small whatever the number of keys."""
    return Window.partitionBy(F.lit(0)).orderBy(ts)


def _as_series(per_ts: DataFrame, frames: list[Frame], ts: str) -> DataFrame:
    """Frames over a table with one row per time, whatever the number of keys: one series, which one task reads batch by batch."""
    return add_frames(per_ts.withColumn("_one", F.lit(0)), frames, Series("_one", ts)).drop("_one")


def regime_z(per_ts: DataFrame, column: str = "univ_median_rv", n: int = 720, ts: str = "ts") -> DataFrame:
    """z-score of a per-time column over n rows, null until there are n."""
    rows = _as_series(per_ts, [Frame(f"_{what}", column, n, what) for what in ("mean", "std", "count")], ts)
    z = safe_div(F.col(column) - F.col("_mean"), null_if_zero("_std"))
    return rows.withColumn(f"{column}_z_{n}", F.when(F.col("_count") == n, z)).drop("_mean", "_std", "_count")


def trailing_percentile(per_ts: DataFrame, column: str, n: int = 2160, ts: str = "ts") -> DataFrame:
    """Share of the other values of the last n rows that are smaller than the present one; null until there are n."""
    return _as_series(per_ts, [Frame(f"{column}_pct_{n}", column, n, "share_below")], ts)


def percent_ranks(df: DataFrame, columns: Sequence[str], ts: str = "ts") -> DataFrame:
    """Percent rank of every column within its time; nulls rank lowest."""
    return df.withColumns({f"rank_{c}": F.percent_rank().over(Window.partitionBy(ts).orderBy(F.col(c).asc_nulls_first())) for c in columns})


def excess(df: DataFrame, column: str, references: Mapping[str, str]) -> DataFrame:
    """column less each reference, a missing reference counting as 0."""
    return df.withColumns({f"{column}_over_{name}": F.col(column) - F.coalesce(F.col(r), F.lit(0.0)) for name, r in references.items()})


def equal_weight_index(df: DataFrame, windows: Sequence[int] = (168, 720), ts: str = "ts", of: str = "logret", weight: str | None = None) -> DataFrame:
    """Mean log return of all keys per time, its sums and variances over windows, null until full. Rows without a positive weight column are left out."""
    live = df.where(F.col(of).isNotNull())
    live = live if weight is None else live.where(F.col(weight) > 0)
    index = live.groupBy(ts).agg(F.avg(of).alias("idx_logret"))
    out = {}
    for n in windows:
        w = over_time(ts).rowsBetween(-(n - 1), 0)
        full = F.count("*").over(w) == n
        out |= {f"idx_cumret_{n}": F.when(full, F.sum("idx_logret").over(w)), f"idx_var_{n}": F.when(full, F.var_pop("idx_logret").over(w))}
    return index.withColumns(out)


def herding(df: DataFrame, index: DataFrame, n: int = 168, ts: str = "ts", key: str = "key", of: str = "logret") -> DataFrame:
    """Index variance over the mean variance of keys, per time."""
    w = Window.partitionBy(key).orderBy(ts).rowsBetween(-(n - 1), 0)
    own = df.withColumn("_var", F.when(F.count("*").over(w) == n, F.var_pop(F.coalesce(F.col(of), F.lit(0.0))).over(w))).groupBy(ts).agg(F.avg("_var").alias("_mean"))
    return index.join(own, ts, "left").withColumn(f"herding_{n}", safe_div(f"idx_var_{n}", "_mean")).drop("_mean")


def reference_block(df: DataFrame, reference: str, columns: Sequence[str], prefix: str, *, key: str = "key", ts: str = "ts", tie: Sequence[str] = ()) -> DataFrame:
    """Columns of one key as a block per time, prefixed; one row per time."""
    w = Window.partitionBy(ts).orderBy(*(tie or columns))
    one = df.where(F.col(key) == reference).select(ts, *columns).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return prefixed(one, prefix, [ts])


def with_references(df: DataFrame, blocks: Sequence[DataFrame], ts: str = "ts") -> DataFrame:
    """df with blocks that have one row per time, left-joined. Whether a block is broadcast is left to the optimizer's size check."""
    for b in blocks:
        df = df.join(b, ts, "left")
    return df


def breadth(df: DataFrame, ts: str = "ts", n: int = 720) -> DataFrame:
    """Share of keys above their long average and near their long high, and the median long return, per time; from horizons()."""
    share = lambda cond: F.avg(F.when(cond, 1.0).when(cond.isNotNull(), 0.0))
    return df.groupBy(ts).agg(
        share(F.col(f"dist_sma_{n}") > 0).alias("breadth_above_sma"), share(F.col(f"drawdown_{n}") > -0.05).alias("breadth_near_high"), median(f"cumret_{n}").alias("breadth_median_return"),
    )


def candle_breadth(df: DataFrame, ts: str = "ts", short: int = 24, exact: bool = True) -> DataFrame:
    """Medians of close location, flow imbalance, range ratio and spread, and shares of true breakouts and squeezes, per time; from the candle operators."""
    share = lambda c: F.avg(F.col(c).cast("double"))
    return df.groupBy(ts).agg(
        median(f"clv_mean_{short}", exact).alias("breadth_clv"), median(f"flow_imbalance_{short}", exact).alias("breadth_flow"), share(f"true_break_high_{short}").alias("breadth_break_high"), share(f"true_break_low_{short}").alias("breadth_break_low"),
        median("atr_ratio", exact).alias("breadth_atr_ratio"), F.avg(F.when(F.col("squeeze_rank") < 0.25, 1.0).otherwise(0.0)).alias("breadth_squeezed"), median(f"cs_spread_{short}", exact).alias("breadth_spread"),
    )


def serving_contract(tokens: DataFrame, stats: DataFrame, references: Sequence[DataFrame], membership: DataFrame | None = None, *, key: str = "key", ts: str = "ts", members_only: bool = False, least_coverage: float = 0.9, include_edge: bool = True, since: Column | None = None, retain_weeks: int = 0) -> DataFrame:
    """Features of tokens with universe statistics, references and weekly membership, filtered for serving.

    membership has (key, week_start, member). With members_only a row stays if its key is a member of its week, or was one
    in the retain_weeks before, and if the time has at least least_coverage of the week's members. Without include_edge
    rows without a next price go.
    """
    out = with_references(tokens.join(stats, ts, "left"), references, ts)
    if since is not None:
        out = out.where(F.col(ts) >= since)
    edge = F.lit(True) if include_edge else F.col("next_price").isNotNull()  # an edge row still counts as present
    if membership is None:
        return out.where(edge)
    week = F.to_date(F.date_trunc("week", ts))
    members = membership.where("member").select(key, "week_start")
    expected = members.groupBy("week_start").agg(F.count("*").alias("expected_members"))
    out = out.withColumn("week_start", week).join(members.withColumn("member", F.lit(True)), [key, "week_start"], "left").join(expected, "week_start", "left")
    out = out.withColumn("member", F.coalesce("member", F.lit(False)))
    if not members_only:
        return out.where(edge)
    served = members.withColumn("week_start", F.explode(F.expr(f"sequence(week_start, week_start + interval {7 * retain_weeks} days, interval 7 days)"))).select(key, "week_start").distinct()
    present = Window.partitionBy(ts)
    out = out.withColumn("_present", F.sum(F.col("member").cast("int")).over(present))
    return out.join(served, [key, "week_start"], "left_semi").where(F.col("_present") >= least_coverage * F.col("expected_members")).where(edge).drop("_present")
