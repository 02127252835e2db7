"""Rolling price, return and volume features of one series per key.

Every operator takes a DataFrame with (key, ts, price, volume ...) and adds columns; rows stay as they are. A frame of n rows is the current row and
the n - 1 before it; a frame of n seconds is an inclusive RANGE, so on an hourly grid 24 hours hold 25 rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.functions.expr import clip, gated, null_if_zero, safe_corr, safe_div, safe_ln, strict_greatest, strict_least, zero


@dataclass(frozen=True)
class Series:
    """Names of the key and time columns, and the windows over them."""

    key: str = "key"
    ts: str = "ts"

    @property
    def ordered(self) -> WindowSpec:
        return Window.partitionBy(self.key).orderBy(self.ts)

    def rows(self, n: int) -> WindowSpec:
        return self.ordered.rowsBetween(-(n - 1), 0)

    def prior(self, n: int) -> WindowSpec:
        return self.ordered.rowsBetween(-n, -1)

    def seconds(self, n: int) -> WindowSpec:
        return Window.partitionBy(self.key).orderBy(F.unix_seconds(self.ts)).rangeBetween(-n, 0)

    @property
    def past(self) -> WindowSpec:
        return self.ordered.rowsBetween(Window.unboundedPreceding, 0)


S = Series()

#: With a frame of more rows than this, all go to frames.add_frames(), where a row's cost doesn't grow with them; shorter ones are left to Spark's windows.
LONG = 12
_NATIVE = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum, "max": F.max, "min": F.min, "count": F.count}


def last_rows(df: DataFrame, wanted: Mapping[str, tuple[str, str, int]], s: Series = S) -> DataFrame:
    """A column for each name: (mean, std, sum, max, min or count, column, n) of the last n rows."""
    from barloom.operators.frames import Frame, add_frames  # which builds on this module

    if all(n <= LONG for _, _, n in wanted.values()):
        return df.withColumns({name: _NATIVE[what](of).over(s.rows(n)) for name, (what, of, n) in wanted.items()})
    return add_frames(df, [Frame(name, of, n, what) for name, (what, of, n) in wanted.items()], s)


def returns(df: DataFrame, s: Series = S, price: str = "price") -> DataFrame:
    """ret, logret (null unless both prices are positive) and the return before."""
    before = F.lag(price).over(s.ordered)
    df = df.withColumns({"ret": safe_div(price, before) - 1, "logret": F.when((F.col(price) > 0) & (before > 0), F.ln(F.col(price) / before))})
    return df.withColumn("prev_ret", F.lag("ret").over(s.ordered))


def mean_std(df: DataFrame, windows: Iterable[int] = (4, 12, 24, 48, 72, 168), s: Series = S, of: str = "ret", prefix: str = "") -> DataFrame:
    return last_rows(df, {f"{prefix}{what}_{n}": (what, of, n) for n in windows for what in ("mean", "std")}, s)


def realized_vol(df: DataFrame, windows: Iterable[int] = (4, 12, 24, 48, 72, 168), s: Series = S) -> DataFrame:
    squared = zero("logret") * zero("logret")
    return df.withColumns({f"rv_{n}": F.sqrt(F.sum(squared).over(s.rows(n))) * math.sqrt(24) for n in windows})


def sharpe(df: DataFrame, windows: Mapping[int, float] | None = None, s: Series = S) -> DataFrame:
    """Mean over deviation of ret, times the window's scale (sqrt 24 by default), and the shortest less the longest."""
    windows = windows or {24: math.sqrt(24), 48: math.sqrt(24), 168: math.sqrt(24)}
    df = df.withColumns({f"sharpe_{n}": safe_div(F.avg("ret").over(s.rows(n)), null_if_zero(F.stddev_samp("ret").over(s.rows(n)))) * scale for n, scale in windows.items()})
    return df.withColumn("sharpe_delta", zero(f"sharpe_{min(windows)}") - zero(f"sharpe_{max(windows)}"))


def zscore(x: str, w: WindowSpec) -> Column:
    return safe_div(F.col(x) - F.avg(x).over(w), null_if_zero(F.stddev_samp(x).over(w)))


def z_scores(df: DataFrame, columns: Sequence[str] = ("ret", "price"), windows: Iterable[int] = (24,), s: Series = S) -> DataFrame:
    return df.withColumns({f"{c}_z_{n}": zscore(c, s.rows(n)) for c in columns for n in windows})


def cumulative_return(df: DataFrame, windows: Iterable[int] = (24, 168), s: Series = S) -> DataFrame:
    return df.withColumns({f"cumret_{n}": F.exp(F.sum(zero("logret")).over(s.rows(n))) - 1 for n in windows})


#: Lengths of a Fibonacci set of averages.
FIBONACCI = (5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610)


def moving_averages(df: DataFrame, windows: Iterable[int] = (6, 12, 24, 26, 72, 168), s: Series = S, price: str = "price", macd: tuple[int, int] | None = (12, 26), spread: tuple[int, int] | None = (6, 24)) -> DataFrame:
    """sma_n, distance of the price to it, and on request a fast less slow average and a difference of distances."""
    windows = tuple(windows)
    df = last_rows(df, {f"sma_{n}": ("mean", price, n) for n in windows}, s)
    df = df.withColumns({f"dist_sma_{n}": safe_div(price, f"sma_{n}") - 1 for n in windows})
    if macd:
        df = df.withColumn(f"macd_{macd[0]}_{macd[1]}", F.col(f"sma_{macd[0]}") - F.col(f"sma_{macd[1]}"))
    if spread:
        df = df.withColumn("sma_spread", F.col(f"dist_sma_{spread[0]}") - F.col(f"dist_sma_{spread[1]}"))
    return df


def slopes(df: DataFrame, columns: Sequence[str], lag: int, s: Series = S) -> DataFrame:
    """(x - x lag rows ago) / lag."""
    return df.withColumns({f"{c}_slope_{lag}": (F.col(c) - F.lag(c, lag).over(s.ordered)) / lag for c in columns})


def extremes(df: DataFrame, windows: Iterable[int] = (4, 12, 24, 48, 168), s: Series = S, price: str = "price") -> DataFrame:
    """Distance to the high (the drawdown) and to the low, and the place in the range."""
    out, windows = {}, tuple(windows)
    df = last_rows(df, {f"_{what}_{n}": (what, price, n) for n in windows for what in ("max", "min")}, s)
    for n in windows:
        high, low = F.col(f"_max_{n}"), F.col(f"_min_{n}")
        out |= {f"dist_high_{n}": safe_div(price, high) - 1, f"dist_low_{n}": safe_div(price, low) - 1, f"range_place_{n}": safe_div(F.col(price) - low, null_if_zero(high - low))}
    return df.withColumns(out).drop(*[f"_{what}_{n}" for n in windows for what in ("max", "min")])


def breakouts(df: DataFrame, windows: Iterable[int] = (24,), s: Series = S, price: str = "price") -> DataFrame:
    """1.0 where the price is beyond the extreme of the n rows before, else 0.0."""
    out = {}
    for n in windows:
        out[f"breakout_high_{n}"] = F.when(F.col(price) > F.max(price).over(s.prior(n)), 1.0).otherwise(0.0)
        out[f"breakout_low_{n}"] = F.when(F.col(price) < F.min(price).over(s.prior(n)), 1.0).otherwise(0.0)
    return df.withColumns(out)


def rsi(df: DataFrame, windows: Iterable[int] = (14,), s: Series = S, of: str = "ret") -> DataFrame:
    """Relative strength on simple averages of gains and losses; 100 without losses."""
    out = {}
    for n in windows:
        gain = F.avg(strict_greatest(of, 0.0)).over(s.rows(n))
        loss = F.avg(strict_greatest(-F.col(of), 0.0)).over(s.rows(n))
        out[f"rsi_{n}"] = F.when(loss.isNull() | (loss == 0), 100.0).otherwise(100 - 100 / (1 + zero(safe_div(gain, loss))))
    return df.withColumns(out)


def autocorrelation(df: DataFrame, windows: Iterable[int] = (24, 72), s: Series = S) -> DataFrame:
    """Lag-1 correlation of ret."""
    return df.withColumns({f"acf1_{n}": safe_corr("ret", "prev_ret", s.rows(n)) for n in windows})


def volume_returns(df: DataFrame, lags: Iterable[int] = (1, 24), s: Series = S, volume: str = "volume", most: float = 10.0) -> DataFrame:
    def change(k: int) -> Column:
        before = F.lag(volume, k).over(s.ordered)
        return clip(safe_div(F.col(volume) - before, before), -most, most)

    return df.withColumns({f"volume_ret_{k}": change(k) for k in lags})


def volume_levels(df: DataFrame, windows: Iterable[int] = (24, 168), s: Series = S, volume: str = "volume", supply: str | None = None) -> DataFrame:
    """ln(1 + volume), of means over time windows (hours), and with a supply the same per unit of supply."""
    out = {"log_volume": F.log1p(volume)} | {f"log_volume_mean_{h}": F.log1p(F.avg(volume).over(s.seconds(h * 3600))) for h in windows}
    if supply:
        out["log_volume_per_supply"] = F.log1p(safe_div(volume, supply))
        out |= {f"log_volume_mean_{h}_per_supply": F.log1p(safe_div(F.avg(volume).over(s.seconds(h * 3600)), supply)) for h in windows}
    return df.withColumns(out)


def volume_features(df: DataFrame, s: Series = S, volume: str = "volume") -> DataFrame:
    """Variation, z-score, spike against the others of 24 h, and accelerations, over inclusive time windows."""
    w6, w24, w168 = (s.seconds(h * 3600) for h in (6, 24, 168))
    total = {h: F.sum(volume).over(w) for h, w in ((6, w6), (24, w24), (168, w168))}
    others = safe_div(total[24] - F.col(volume), F.count("*").over(w24) - 1)
    return df.withColumns({
        "volume_cv_24": safe_div(F.stddev_samp(volume).over(w24), F.avg(volume).over(w24)), "volume_cv_168": safe_div(F.stddev_samp(volume).over(w168), F.avg(volume).over(w168)),
        "volume_spike_24": safe_div(volume, others), "volume_z_24": zscore(volume, w24),
        "volume_accel_6_24": safe_div(total[6] - total[24], total[24]), "volume_accel_24_168": safe_div(total[24] - total[168], total[168]),
    })


def volume_weighted_decay(df: DataFrame, alphas: Mapping[str, float] | None = None, s: Series = S, volume: str = "volume", decay: str = "reference") -> DataFrame:
    """Decaying volume averages. decay="reference" weighs the row number n by alpha^n, so the oldest rows dominate; "recent" weighs the age."""
    alphas = alphas or {"fast": 0.75, "slow": 0.9}
    n = F.row_number().over(s.ordered)
    out = {}
    for name, a in alphas.items():
        if decay == "reference":
            weight = F.pow(F.lit(a), n)
        elif decay == "recent":
            from barloom.operators.ema import ema  # which builds on this module

            df = ema(df.withColumn("_filled", F.coalesce(volume, F.lit(0.0))), s=s, of="_filled", keep=a, name=f"volume_ema_{name}").drop("_filled")
            continue
        else:
            raise ValueError("decay is 'reference' or 'recent'")
        df = df.withColumn(f"_weight_{name}", weight)
        out[f"volume_ema_{name}"] = safe_div(F.sum(F.col(volume) * F.col(f"_weight_{name}")).over(s.past), F.sum(f"_weight_{name}").over(s.past))
    return df.withColumns(out).drop(*[f"_weight_{name}" for name in alphas])


def vwap(df: DataFrame, windows: Iterable[int] = (4, 24), s: Series = S, price: str = "price", volume: str = "volume") -> DataFrame:
    windows = tuple(windows)
    df = df.withColumns({f"vwap_{n}": safe_div(F.sum(F.col(price) * F.col(volume)).over(s.rows(n)), F.sum(volume).over(s.rows(n))) for n in windows})
    return df.withColumns({f"dist_vwap_{n}": safe_div(price, f"vwap_{n}") - 1 for n in windows})


def liquidity(df: DataFrame, n: int = 24, s: Series = S, price: str = "price", volume: str = "volume") -> DataFrame:
    """Amihud by unit and by dollar volume, Roll's effective spread in basis points, and dollar volume sum, variation, minimum and tenth percentile."""
    from barloom.operators.frames import Frame, add_frames

    df = df.withColumn("dollar_volume", zero(volume) * zero(price))
    w = s.rows(n)
    moved = F.abs(zero("ret"))
    cov = F.covar_samp(zero("ret"), F.col("prev_ret")).over(w)
    df = add_frames(df, [Frame(f"dollar_volume_p10_{n}", "dollar_volume", n, "kth", 0.1)], s)
    return df.withColumns({
        f"amihud_{n}": F.avg(safe_div(moved, volume)).over(w), f"dollar_amihud_{n}": F.avg(safe_div(moved, "dollar_volume")).over(w),
        f"spread_bps_{n}": F.when(cov < 0, 2 * F.sqrt(-cov) * 10_000).otherwise(0.0), f"dollar_volume_{n}": F.sum("dollar_volume").over(w),
        f"dollar_volume_cv_{n}": safe_div(F.stddev_samp("dollar_volume").over(w), F.avg("dollar_volume").over(w)), f"dollar_volume_min_{n}": F.min("dollar_volume").over(w),
    })


def ols_trend(df: DataFrame, windows: Iterable[int] = (168,), s: Series = S, of: str = "log_price", gate: bool = True) -> DataFrame:
    """Slope and R2 of the column against the row number. Sums over a long frame come from running sums, so the cost doesn't grow with the frame.

    Values are centred on the key's mean first. Null values leave the frame out of the gate but not of the sums' counts.
    """
    windows = tuple(windows)
    per_key = Window.partitionBy(s.key)
    df = df.withColumn("_n", F.row_number().over(s.ordered).cast("double")).withColumn("_y", F.col(of) - F.avg(of).over(per_key))
    df = df.withColumn("_x", F.when(F.col("_y").isNotNull(), F.col("_n") - F.max("_n").over(per_key) / 2))
    terms = {"c": F.when(F.col("_x").isNotNull(), 1.0).otherwise(0.0), "x": zero("_x"), "y": zero("_y"), "xx": zero(F.col("_x") * F.col("_x")), "yy": zero(F.col("_y") * F.col("_y")), "xy": zero(F.col("_x") * F.col("_y"))}
    df = df.withColumns({f"_s{k}": F.sum(v).over(s.past) for k, v in terms.items()})
    out = {}
    for n in windows:
        t = {k: F.col(f"_s{k}") - F.coalesce(F.lag(f"_s{k}", n).over(s.ordered), F.lit(0.0)) for k in terms}
        cov = t["xy"] - safe_div(t["x"] * t["y"], t["c"])
        var_x, var_y = t["xx"] - safe_div(t["x"] * t["x"], t["c"]), t["yy"] - safe_div(t["y"] * t["y"], t["c"])
        full = F.lit(True) if not gate else t["c"] == n
        r2 = F.when(var_y > 1e-12, safe_div(cov * cov, var_x * var_y)).otherwise(0.0)
        out |= {f"trend_slope_{n}": F.when(full & (t["c"] >= 2), safe_div(cov, var_x)), f"trend_r2_{n}": F.when(full & (t["c"] >= 2), strict_least(r2, 1.0)), f"trend_count_{n}": t["c"]}
    return df.withColumns(out).drop("_n", "_y", "_x", *[f"_s{k}" for k in terms])


def trend_state(df: DataFrame, n: int) -> DataFrame:
    """t-statistic, speed over the horizon (exponent held to 20 either way) and a label, from ols_trend()."""
    slope, r2, count = F.col(f"trend_slope_{n}"), F.col(f"trend_r2_{n}"), F.col(f"trend_count_{n}")
    t = F.when(r2.isNotNull() & (r2 < 1) & (count >= 3), F.signum(slope) * F.sqrt((count - 2) * safe_div(r2, 1 - r2)))
    speed = F.when(slope.isNotNull() & (count >= 3) & (r2 >= 1e-6), F.exp(clip(slope * n, -20, 20)) - 1)
    df = df.withColumns({f"trend_t_{n}": t, f"trend_speed_{n}": speed})
    state = F.when(F.abs(f"trend_t_{n}") < 2, "flat").when(F.col(f"trend_speed_{n}") > 0, "up").when(F.col(f"trend_speed_{n}") < 0, "down")
    return df.withColumns({f"trend_state_{n}": state, f"trend_score_{n}": F.col(f"trend_speed_{n}") * r2})


def log_gaps(df: DataFrame, n: int = 720, s: Series = S) -> DataFrame:
    """Distance of the cumulative log return from its highest and lowest value of n rows; null until there are n."""
    df = df.withColumns({"_cum": F.sum(zero("logret")).over(s.past), "_full": F.row_number().over(s.ordered) >= n})
    df = last_rows(df, {"_high": ("max", "_cum", n), "_low": ("min", "_cum", n)}, s)
    return df.withColumns({f"log_gap_{k}_{n}": F.when(F.col("_full"), F.col("_cum") - F.col(f"_{k}")) for k in ("high", "low")}).drop("_cum", "_full", "_high", "_low")


def band_widths(df: DataFrame, windows: Iterable[int] = (24, 168), s: Series = S, price: str = "price") -> DataFrame:
    """Bollinger bandwidth (two deviations over the mean) and Donchian width (range over the mean)."""
    out = {}
    for n in windows:
        w = s.rows(n)
        out |= {f"bollinger_width_{n}": safe_div(2 * F.stddev_samp(price).over(w), F.avg(price).over(w)), f"donchian_width_{n}": safe_div(F.max(price).over(w) - F.min(price).over(w), F.avg(price).over(w))}
    return df.withColumns(out)


def persistence(df: DataFrame, windows: Iterable[int] = (24, 72), s: Series = S) -> DataFrame:
    """Counts of rising and falling rows, their difference over all, and choppiness (path over net move, held to 100; null without a net move, for which rounding isn't taken)."""
    out = {}
    for n in windows:
        w = s.rows(n)
        path, net = F.sum(F.abs("logret")).over(w), F.abs(F.sum("logret").over(w))
        up, down = (F.sum(F.when(cond, 1).otherwise(0)).over(w) for cond in (F.col("ret") > 0, F.col("ret") < 0))
        out |= {f"up_count_{n}": up, f"down_count_{n}": down, f"momentum_run_{n}": safe_div(up - down, n), f"chop_{n}": clip(F.when(net > 1e-12 * path, safe_div(path, net)), 0, 100)}
    return df.withColumns(out)


def skewness(df: DataFrame, n: int = 168, s: Series = S, of: str = "logret", most: float = 10.0) -> DataFrame:
    """Population skew from moments, held to most either way; null until n rows."""
    x, w = zero(of), s.rows(n)
    m1, m2, m3 = (F.avg(F.pow(x, F.lit(float(k)))).over(w) for k in (1, 2, 3))
    spread = m2 - m1 * m1
    skew = F.when(spread > 1e-18, (m3 - 3 * m1 * m2 + 2 * m1 * m1 * m1) / F.pow(spread, F.lit(1.5)))
    return df.withColumn(f"skew_{n}", gated(clip(skew, -most, most), w, n))


def beta_to(df: DataFrame, reference: str, n: int = 72, s: Series = S, of: str = "ret") -> DataFrame:
    """beta, alpha return and summed spread against a reference return column of the same rows."""
    w = s.rows(n)
    both = F.col(of).isNotNull() & F.col(reference).isNotNull()
    x, y = F.when(both, F.col(reference)), F.when(both, F.col(of))
    cov = F.avg(x * y).over(w) - F.avg(x).over(w) * F.avg(y).over(w)
    std = F.stddev_samp(x).over(w)
    df = df.withColumn(f"beta_{n}", safe_div(cov, null_if_zero(std * std)))
    return df.withColumns({f"alpha_{n}": F.col(of) - F.col(f"beta_{n}") * F.col(reference), f"spread_sum_{n}": F.sum(y - x).over(w)})


def return_volume_correlation(df: DataFrame, n: int = 72, s: Series = S, volume: str = "volume") -> DataFrame:
    return df.withColumn(f"ret_volume_corr_{n}", safe_corr("ret", volume, s.rows(n)))


def calendar(df: DataFrame, s: Series = S, pi: float = math.pi) -> DataFrame:
    """Hour, day of week (Sunday 1), their sines and cosines, and a weekend flag."""
    hour, day = F.hour(s.ts).cast("double"), F.dayofweek(s.ts).cast("double")
    return df.withColumns({
        "hour_of_day": hour, "day_of_week": day, "sin_hour": F.sin(2 * pi * hour / 24), "cos_hour": F.cos(2 * pi * hour / 24),
        "sin_day": F.sin(2 * pi * day / 7), "cos_day": F.cos(2 * pi * day / 7), "is_weekend": F.when(day.isin(1.0, 7.0), 1.0).otherwise(0.0),
    })


def ratios(df: DataFrame) -> DataFrame:
    """Ratios of realized volatilities, return over volatility and strength times the ratio; from realized_vol() and rsi()."""
    ratio = safe_div("rv_24", "rv_168")
    return df.withColumns({"vol_ratio_24_168": ratio, "ret_over_rv_24": safe_div("ret", "rv_24"), "rsi_vol": zero(safe_div(F.col("rsi_14") * ratio, 100.0))})


def completeness(df: DataFrame, windows: Iterable[int] = (24, 72, 168), s: Series = S) -> DataFrame:
    """has_n: all n returns of the frame are there; missing_n: how many aren't."""
    counts = {n: F.count("ret").over(s.rows(n)) for n in windows}
    return df.withColumns({f"has_{n}": c == n for n, c in counts.items()} | {f"missing_{n}": n - c for n, c in counts.items()})


def cost_model(df: DataFrame, trade_usd: float = 250.0, dollar_volume: str = "dollar_volume_24", cap: str = "mktcap") -> DataFrame:
    """Fee (log-linear, at most 500 basis points) and slippage steps by the trade's share of dollar volume."""
    # Coefficients of the fee model and steps of the slippage.
    base, by_trade, by_share, by_turnover, by_volume, by_cap = -0.371, 0.573, 0.424, 0.218, 0.149, -0.069
    steps = ((0.005, 300.0), (0.0005, 50.0), (0.0, 10.0))
    volume, size = F.greatest(zero(dollar_volume), F.lit(1.0)), F.greatest(zero(cap), F.lit(1.0))
    share = trade_usd / volume
    least = F.lit(1e-10)
    log_fee = base + by_trade * math.log(max(trade_usd, 1.0)) + by_share * F.ln(F.greatest(share, least)) + by_turnover * F.ln(F.greatest(zero(dollar_volume) / size, least)) + by_volume * F.ln(volume) + by_cap * F.ln(size)
    slippage = F.lit(steps[-1][1])
    for least_share, bps in reversed(steps[:-1]):
        slippage = F.when(share > least_share, bps).otherwise(slippage)
    return df.withColumns({"fee_bps": F.least(F.exp(log_fee) / trade_usd * 10_000, F.lit(500.0)), "slippage_bps": slippage})


def volatility_slippage(df: DataFrame, low: float = 5.0, high: float = 300.0, factor: float = 1000.0) -> DataFrame:
    """Slippage that follows the 24-row volatility, held to [low, high] basis points."""
    return df.withColumn("slippage_vol_bps", clip(zero("rv_24") * factor, low, high))


def next_bar(df: DataFrame, s: Series = S, price: str = "price", keep_edge: bool = True) -> DataFrame:
    """Price of the next bar; the last row of a key has none and stays only with keep_edge."""
    out = df.withColumn("next_price", F.lead(price).over(s.ordered))
    return out if keep_edge else out.where(F.col("next_price").isNotNull())


def activity_features(df: DataFrame, columns: Sequence[str], n: int = 168, s: Series = S) -> DataFrame:
    """Growth, log growth, and level, variation and z against the last n rows, for each activity column."""
    out = {}
    w = s.rows(n)
    for c in columns:
        before = F.lag(c).over(s.ordered)
        mean, std = F.avg(c).over(w), F.stddev_samp(c).over(w)
        out |= {
            f"{c}_growth": safe_div(F.col(c) - before, before), f"{c}_log_growth": F.when((F.col(c) > 0) & (before > 0), F.ln(F.col(c) / before)), f"{c}_rel_mean": safe_div(c, mean),
            f"{c}_rel_std": safe_div(std, mean), f"{c}_share": safe_div(c, F.sum(c).over(w)), f"{c}_z": zscore(c, w), f"{c}_drawdown": safe_div(c, F.max(c).over(w)) - 1,
            f"{c}_vol_ratio": safe_div(F.stddev_samp(c).over(s.rows(24)), std),
        }
    return df.withColumns(out)


def activity_ratios(df: DataFrame, columns: Sequence[str], short: Sequence[int] = (4, 6, 12, 24, 72), long: int = 168, spreads: Sequence[tuple[int, int]] = ((6, 24), (12, 72), (24, 168)), s: Series = S) -> DataFrame:
    """For each activity column: growth over 6 and 24 rows, means, deviations and sums of short windows against the long one, ratios of deviations, means over deviations up to 24 rows, and z-scores of 6 to 24."""
    out = {}
    df = df.withColumns({f"{c}_growth_{n}": safe_div(c, F.lag(c, n).over(s.ordered)) - 1 for c in columns for n in (6, 24)})
    lengths = sorted({*short, long, *(n for pair in spreads for n in pair)})
    frames = {f"_{what}_{c}_{n}": (what, c, n) for c in columns for n in lengths for what in ("mean", "std", "sum")}
    df = last_rows(df, frames, s)
    for c in columns:
        mean, std, total = ((lambda n, what=what: F.col(f"_{what}_{c}_{n}")) for what in ("mean", "std", "sum"))
        for n in short:
            out |= {f"{c}_rel_mean_{n}": safe_div(mean(n), mean(long)), f"{c}_rel_std_{n}": safe_div(std(n), std(long)), f"{c}_rel_cum_{n}": safe_div(total(n), total(long))}
            if n <= 24:
                out[f"{c}_sharpe_{n}"] = safe_div(mean(n), std(n))
            if 6 <= n <= 24:
                out[f"{c}_z_{n}"] = safe_div(F.col(c) - mean(n), std(n))
        out |= {f"{c}_vol_ratio_{a}_{b}": safe_div(std(a), std(b)) for a, b in spreads}
    return df.withColumns(out).drop(*frames)


def volume_autocorrelation(df: DataFrame, hours: int = 24, s: Series = S, volume: str = "volume") -> DataFrame:
    """Lag-1 correlation of volume over an inclusive time window."""
    return df.withColumn("_before", F.lag(volume).over(s.ordered)).withColumn(f"volume_acf1_{hours}", safe_corr(volume, "_before", s.seconds(hours * 3600))).drop("_before")


def age(df: DataFrame, s: Series = S) -> DataFrame:
    """Row number and whole days since the key's first row."""
    return df.withColumns({"age_rows": F.row_number().over(s.ordered), "age_days": F.datediff(s.ts, F.min(s.ts).over(Window.partitionBy(s.key)))})


def horizons(df: DataFrame, windows: Iterable[int] = (336, 720), gap: int = 2160, s: Series = S, price: str = "price") -> DataFrame:
    """Long returns, drawdowns and distances to averages, gaps to highs, and how long ago the record high was; null until the window is full."""
    df = df.withColumns({"_i": F.row_number().over(s.ordered), "_cum": F.sum(zero("logret")).over(s.past), "_record": F.max(price).over(s.past)})
    full = lambda n, x: F.when(F.col("_i") >= n, x)
    out, windows = {}, tuple(windows)
    df = last_rows(df, {f"_{what}_{n}": (what, price, n) for n in windows for what in ("max", "mean")} | {"_gap": ("max", "_cum", gap)}, s)
    for n in windows:
        cum = F.col("_cum") - F.coalesce(F.lag("_cum", n).over(s.ordered), F.lit(0.0))
        out |= {f"cumret_{n}": full(n, F.exp(cum) - 1), f"drawdown_{n}": full(n, safe_div(price, f"_max_{n}") - 1), f"dist_sma_{n}": full(n, safe_div(price, f"_mean_{n}") - 1)}
    out |= {f"log_gap_high_{gap}": full(gap, F.col("_cum") - F.col("_gap")), "log_gap_record": F.col("_cum") - F.max("_cum").over(s.past)}
    out["record_age"] = F.when(F.col("_i") > 1, safe_div(F.col("_i") - F.max(F.when(F.col(price) >= F.col("_record"), F.col("_i"))).over(s.past), F.col("_i") - 1))
    return df.withColumns(out).drop("_i", "_cum", "_record", "_gap", *[f"_{what}_{n}" for n in windows for what in ("max", "mean")])


def quality_features(df: DataFrame, s: Series = S, pullback: int = 720, align: int = 168, up: int = 72) -> DataFrame:
    """Abnormal drawdown, agreement of returns and volume, share of rising bars and acceleration; from extremes(), volume_features() and cumulative_return()."""
    return df.withColumns({
        "pullback_z": gated(zscore("dist_high_168", s.rows(pullback)), s.rows(pullback), pullback), "volume_momentum_align": gated(clip(safe_corr(zero("logret"), F.col("volume_z_24"), s.rows(align)), -1, 1), s.rows(align), align),
        "up_bar_share": gated(F.avg(F.when(F.col("logret") > 0, 1.0).otherwise(0.0)).over(s.rows(up)), s.rows(up), up), "momentum_accel": F.col("cumret_24") - F.col("cumret_168") * 24 / 168,
    })


def idiosyncratic(df: DataFrame, reference: str, reference_cumret: str, cumret: str = "cumret_168", n: int = 1440, s: Series = S) -> DataFrame:
    """Beta to a reference log return (held to [-2, 5]), what of the return it doesn't explain, and the idiosyncratic share of variance."""
    x, y, w = F.col(reference), zero("logret"), s.rows(n)
    df = df.withColumn("idio_beta", gated(clip(safe_div(F.covar_pop(y, x).over(w), null_if_zero(F.var_pop(x).over(w))), -2, 5), w, n))
    corr = safe_corr(y, x, w)
    return df.withColumns({"idio_momentum": F.col(cumret) - F.col("idio_beta") * F.col(reference_cumret), "idio_share": gated(clip(1 - corr * corr, 0, 1), w, n)})


def dormancy(df: DataFrame, hot: float = 2.0, s: Series = S) -> DataFrame:
    """ln(1 + days since volume was last hot), and times the present volume z-score."""
    df = df.withColumn("_i", F.row_number().over(s.ordered))
    since = F.col("_i") - F.coalesce(F.max(F.when(F.col("volume_z_24") >= hot, F.col("_i"))).over(s.past), F.lit(0))
    days = F.log1p(since / 24)
    return df.withColumns({"dormancy": days, "reawakening": days * strict_greatest("volume_z_24", 0.0)}).drop("_i")


def vpin(df: DataFrame, windows: tuple[int, int] = (24, 168), z: int = 720, s: Series = S) -> DataFrame:
    """Toxic share of dollar volume by bulk classification, and its z-score; needs dollar_volume and std_24."""
    df = df.withColumn("_toxic", F.abs(F.tanh(0.851 * safe_div(zero("logret"), null_if_zero("std_24")))) * F.col("dollar_volume"))
    df = df.withColumns({f"vpin_{n}": gated(safe_div(F.sum("_toxic").over(s.rows(n)), F.sum("dollar_volume").over(s.rows(n))), s.rows(n), n) for n in windows})
    return df.withColumn("vpin_z", gated(zscore(f"vpin_{windows[0]}", s.rows(z)), s.rows(z), z)).drop("_toxic")


def jumps(df: DataFrame, windows: Iterable[int] = (24, 168), s: Series = S) -> DataFrame:
    """Share of jumps in variance (bipower), gated one row later, and share of falling returns."""
    r = zero("logret")
    df = df.withColumns({"_r2": r * r, "_bp": F.abs(r) * F.abs(F.lag(r).over(s.ordered)), "_down": F.when(r < 0, r * r).otherwise(0.0)})
    out = {}
    for n in windows:
        w = s.rows(n)
        total = F.sum("_r2").over(w)
        enough = F.count("*").over(s.past) > n
        out[f"jump_share_{n}"] = F.when(enough, safe_div(strict_greatest(total - math.pi / 2 * F.sum("_bp").over(w), 0.0), null_if_zero(total)))
        out[f"down_share_{n}"] = gated(safe_div(F.sum("_down").over(w), null_if_zero(total)), w, n)
    return df.withColumns(out).drop("_r2", "_bp", "_down")


def log_price(df: DataFrame, price: str = "price") -> DataFrame:
    return df.withColumn("log_price", safe_ln(price))
