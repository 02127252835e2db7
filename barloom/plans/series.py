"""Queries over bars, grids and rolling features of one series per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.expr import rounded
from barloom.operators import bars as B
from barloom.operators import rolling as R
from barloom.operators.frames import Frame, add_frames, running
from barloom.plans.adapters import DAILY, DAILY_RETURNS, GRID, HOURLY, RETURNS, TICKS, daily, daily_grid, grid, hourly, hours, load, prior, r6, ticks, w
from barloom.plans.registry import query


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.returns(grid(spark, sf_dir)).withColumn("dollar_volume", F.coalesce("volume", F.lit(0.0)) * F.coalesce("price", F.lit(0.0)))


def daily_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over one series for each supplier."""
    return R.returns(daily_grid(spark, sf_dir)).withColumn("dollar_volume", F.coalesce("volume", F.lit(0.0)) * F.coalesce("price", F.lit(0.0)))


def out(df: DataFrame, *columns: str) -> DataFrame:
    return rounded(df.select("key", "ts", *columns))


def over_r(columns: dict[str, str], *windows: str, more: str = "", source: str = "r", ctes: str = RETURNS) -> str:
    """SELECT of rounded expressions over the returns CTE."""
    named = f" WINDOW {', '.join(windows)}" if windows else ""
    return f"WITH {ctes}{more} SELECT key, ts, {', '.join(r6(x, n) for n, x in columns.items())} FROM {source}{named}"


@query(f"WITH {HOURLY} SELECT key, ts, {', '.join(r6(c, c) for c in ('open', 'high', 'low', 'close', 'volume'))} FROM bars")
def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(hourly(spark, sf_dir).select("key", "ts", "open", "high", "low", "close", "volume"))


@query(f"WITH {DAILY} SELECT key, ts, {', '.join(r6(c, c) for c in ('open', 'high', 'low', 'close', 'volume'))} FROM daily")
def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(daily(spark, sf_dir).select("key", "ts", "open", "high", "low", "close", "volume"))


@query(f"WITH {TICKS} SELECT key, date_trunc('hour', ts) AS ts, {r6('avg(price)', 'price')}, {r6('max(volume)', 'volume')} FROM ticks WHERE price > 0 GROUP BY key, date_trunc('hour', ts)")
def hourly_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(B.hourly_mean(ticks(spark, sf_dir)), "price", "volume")


@query(f"WITH {GRID} SELECT key, ts, {r6('price', 'price')}, {r6('volume', 'volume')} FROM grid")
def filled_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(grid(spark, sf_dir), "price", "volume")


@query(f"WITH {TICKS} SELECT key, date_trunc('hour', ts) AS ts, {r6('price', 'price')}, {r6('volume', 'volume')}, event_id FROM ticks QUALIFY row_number() OVER (PARTITION BY key, date_trunc('hour', ts) ORDER BY ts DESC, event_id DESC) = 1")
def last_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(B.last_in_bucket(ticks(spark, sf_dir), tie=["event_id"]), "price", "volume", "event_id")


@query(f"""WITH {HOURLY}, seen AS (SELECT key, ts, lag(ts) OVER (PARTITION BY key ORDER BY ts) AS gap_start FROM bars)
SELECT key, gap_start, ts AS gap_end, CAST(floor((epoch(ts) - epoch(gap_start)) / 3600) AS BIGINT) AS gap_steps, CAST(floor((epoch(ts) - epoch(gap_start)) / 3600) - 1 AS BIGINT) AS missing FROM seen WHERE epoch(ts) - epoch(gap_start) >= 7200""")
def bar_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.find_gaps(hourly(spark, sf_dir))


@query(f"""WITH {DAILY}, facts AS (SELECT s_suppkey AS key, max(CASE WHEN s_suppkey % 3 = 0 THEN -s_acctbal ELSE s_acctbal END) / 1000 AS supply, max(s_acctbal * 2) AS stored FROM supplier GROUP BY s_suppkey)
SELECT d.key, d.ts, {r6('d.close', 'close')}, {r6("CASE WHEN d.key NOT IN (1, 2) THEN coalesce(CASE WHEN supply > 0 THEN d.close * supply END, stored) END", 'mktcap')} FROM daily d LEFT JOIN facts ON facts.key = d.key""")
def market_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    supply = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), (F.when(F.col("s_suppkey") % 3 == 0, -F.col("s_acctbal")).otherwise(F.col("s_acctbal")) / 1000).alias("supply"), (F.col("s_acctbal") * 2).alias("stored_mktcap"))
    return out(B.with_market_cap(daily(spark, sf_dir), supply, price="close", reference=[1, 2]), "close", "mktcap")


_PIVOT = "(high + low + close) / 3"


@query(f"WITH {DAILY} SELECT key, ts, {r6(_PIVOT, 'pivot')}, {r6(f'2 * {_PIVOT} - low', 'r1')}, {r6(f'2 * {_PIVOT} - high', 's1')}, {r6(f'{_PIVOT} + (high - low)', 'r2')}, {r6(f'{_PIVOT} - (high - low)', 's2')} FROM daily")
def pivot_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(B.pivot_levels(daily(spark, sf_dir)), "pivot", "r1", "s1", "r2", "s2")


@query(f"""WITH {HOURLY}, g AS (SELECT key, ts, lag(ts) OVER (PARTITION BY key ORDER BY ts) AS a FROM bars), gaps AS (SELECT key FROM g WHERE epoch(ts) - epoch(a) >= 6 * 3600)
SELECT key, ts, {r6('close', 'close')} FROM bars WHERE key NOT IN (SELECT key FROM gaps) AND key <> 'view'""")
def clean_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir)
    gaps = B.find_gaps(b).where("gap_steps >= 6")
    return out(B.clean_universe(b, gaps, spark.createDataFrame([("view",)], "key string")), "close")


@query(f"""WITH {GRID} SELECT g.key, g.ts, {r6('g.price', 'price')} FROM grid g JOIN grid a ON a.key = g.key AND hour(a.ts) = 5 AND a.price >= 250 AND g.ts <= a.ts AND g.ts > a.ts - INTERVAL 48 HOUR""")
def anchored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grid(spark, sf_dir).withColumn("mktcap", F.col("price"))
    return out(B.anchored_windows(g, min_cap=250.0, hours=48), "price")


@query("""SELECT token, wallets, latest FROM (SELECT l_partkey AS token, count(DISTINCT o_custkey) AS wallets, max(o_orderdate) AS latest FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey)
WHERE wallets >= 5 AND latest >= TIMESTAMP '2001-06-01' - INTERVAL 900 DAY""")
def widely_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("wallet"), F.col("o_orderdate").alias("last_ts"))
    held = load(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("token")).join(o, "l_orderkey")
    return B.wallet_token_filter(held, min_wallets=5, active_days=900, as_of=F.lit("2001-06-01").cast("timestamp"))


@query(f"WITH {HOURLY}, pegged AS (SELECT key FROM bars GROUP BY key HAVING abs(avg(close) - 250) <= 5) SELECT key, ts, {r6('close', 'close')} FROM bars WHERE key NOT IN (SELECT key FROM pegged)")
def without_pegged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(B.exclude_pegged(hourly(spark, sf_dir), level=250.0, tolerance=5.0), "close")


@query("""SELECT CAST(floor(least(greatest(value, 50.0), 400.0) / 25.0) * 25.0 AS DOUBLE) AS bucket, count(*) AS n,
format('{:.1f}..{:.1f}', floor(least(greatest(value, 50.0), 400.0) / 25.0) * 25.0, floor(least(greatest(value, 50.0), 400.0) / 25.0) * 25.0 + 25.0) AS label FROM events WHERE value IS NOT NULL GROUP BY 1, 3""")
def value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.histogram(load(spark, sf_dir, "events"), "value", 25.0, 50.0, 400.0)


@query(over_r({"ret": "ret", "logret": "logret", "prev_ret": "prev_ret"}))
def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(base(spark, sf_dir), "ret", "logret", "prev_ret")


@query(over_r({"ret": "ret", "logret": "logret", "prev_ret": "prev_ret"}, ctes=DAILY_RETURNS))
def daily_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(daily_base(spark, sf_dir), "ret", "logret", "prev_ret")


_N = (4, 12, 24, 48, 72, 168)


@query(over_r({f"{p}_{n}": f"{f}(ret) OVER w{n}" for n in _N for p, f in (("mean", "avg"), ("std", "stddev_samp"))}, *[w(f"w{n}", n) for n in _N], ctes=DAILY_RETURNS))
def daily_mean_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.mean_std(daily_base(spark, sf_dir), _N), *[f"{p}_{n}" for n in _N for p in ("mean", "std")])


@query(over_r({f"{p}_{n}": f"{f}(ret) OVER w{n}" for n in _N for p, f in (("mean", "avg"), ("std", "stddev_samp"))}, *[w(f"w{n}", n) for n in _N]))
def rolling_mean_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.mean_std(base(spark, sf_dir), _N), *[f"{p}_{n}" for n in _N for p in ("mean", "std")])


@query(over_r({f"rv_{n}": f"sqrt(sum(lr * lr) OVER w{n}) * sqrt(24)" for n in _N}, *[w(f"w{n}", n) for n in _N]))
def realized_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.realized_vol(base(spark, sf_dir), _N), *[f"rv_{n}" for n in _N])


_SHARPE = {n: f"avg(ret) OVER w{n} / nullif(stddev_samp(ret) OVER w{n}, 0) * sqrt(24)" for n in (24, 48, 168)}


@query(over_r({f"sharpe_{n}": x for n, x in _SHARPE.items()} | {"sharpe_delta": f"coalesce({_SHARPE[24]}, 0) - coalesce({_SHARPE[168]}, 0)"}, *[w(f"w{n}", n) for n in _SHARPE]))
def sharpe_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.sharpe(base(spark, sf_dir)), "sharpe_24", "sharpe_48", "sharpe_168", "sharpe_delta")


def _z(x: str, win: str) -> str:
    return f"({x} - avg({x}) OVER {win}) / nullif(stddev_samp({x}) OVER {win}, 0)"


@query(over_r({"ret_z_24": _z("ret", "w24"), "price_z_24": _z("price", "w24")}, w("w24", 24)))
def rolling_z_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.z_scores(base(spark, sf_dir)), "ret_z_24", "price_z_24")


@query(over_r({f"cumret_{n}": f"exp(sum(lr) OVER w{n}) - 1" for n in (24, 168)}, w("w24", 24), w("w168", 168)))
def cumulative_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.cumulative_return(base(spark, sf_dir)), "cumret_24", "cumret_168")


_SMA = (6, 12, 24, 26, 72, 168)


@query(over_r(
    {f"sma_{n}": f"avg(price) OVER w{n}" for n in _SMA} | {f"dist_sma_{n}": f"price / nullif(avg(price) OVER w{n}, 0) - 1" for n in _SMA}
    | {"macd_12_26": "avg(price) OVER w12 - avg(price) OVER w26", "sma_spread": "price / avg(price) OVER w6 - price / avg(price) OVER w24"}, *[w(f"w{n}", n) for n in _SMA]))
def moving_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.moving_averages(base(spark, sf_dir)), *[f"sma_{n}" for n in _SMA], *[f"dist_sma_{n}" for n in _SMA], "macd_12_26", "sma_spread")


@query(over_r({f"sma_{n}": f"avg(price) OVER w{n}" for n in R.FIBONACCI}, *[w(f"w{n}", n) for n in R.FIBONACCI]))
def fibonacci_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.moving_averages(base(spark, sf_dir), R.FIBONACCI, macd=None, spread=None), *[f"sma_{n}" for n in R.FIBONACCI])


@query(over_r({"dist_sma_24_slope_6": "(d - lag(d, 6) OVER (PARTITION BY key ORDER BY ts)) / 6"}, more=f", m AS (SELECT key, ts, price / nullif(avg(price) OVER w24, 0) - 1 AS d FROM r WINDOW {w('w24', 24)})", source="m"))
def distance_slopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.slopes(R.moving_averages(base(spark, sf_dir)), ["dist_sma_24"], 6), "dist_sma_24_slope_6")


@query(over_r({k: v for n in (4, 12, 24, 48, 168) for k, v in {
    f"dist_high_{n}": f"price / nullif(max(price) OVER w{n}, 0) - 1", f"dist_low_{n}": f"price / nullif(min(price) OVER w{n}, 0) - 1",
    f"range_place_{n}": f"(price - min(price) OVER w{n}) / nullif(max(price) OVER w{n} - min(price) OVER w{n}, 0)"}.items()}, *[w(f"w{n}", n) for n in (4, 12, 24, 48, 168)]))
def price_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.extremes(base(spark, sf_dir)), *[f"{p}_{n}" for n in (4, 12, 24, 48, 168) for p in ("dist_high", "dist_low", "range_place")])


@query(over_r({"breakout_high_24": "CASE WHEN price > max(price) OVER p24 THEN 1.0 ELSE 0.0 END", "breakout_low_24": "CASE WHEN price < min(price) OVER p24 THEN 1.0 ELSE 0.0 END"}, prior("p24", 24)))
def breakouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.breakouts(base(spark, sf_dir)), "breakout_high_24", "breakout_low_24")


def _rsi(n: int) -> str:
    g, lo = f"avg(CASE WHEN ret IS NOT NULL THEN greatest(ret, 0) END) OVER w{n}", f"avg(CASE WHEN ret IS NOT NULL THEN greatest(-ret, 0) END) OVER w{n}"
    return f"CASE WHEN {lo} IS NULL OR {lo} = 0 THEN 100 ELSE 100 - 100 / (1 + coalesce(({g}) / ({lo}), 0)) END"


@query(over_r({"rsi_6": _rsi(6), "rsi_14": _rsi(14)}, w("w6", 6), w("w14", 14), ctes=DAILY_RETURNS))
def daily_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.rsi(daily_base(spark, sf_dir), (6, 14)), "rsi_6", "rsi_14")


@query(over_r({"rsi_6": _rsi(6), "rsi_14": _rsi(14)}, w("w6", 6), w("w14", 14)))
def relative_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.rsi(base(spark, sf_dir), (6, 14)), "rsi_6", "rsi_14")


def _corr(x: str, y: str, win: str) -> str:
    a, b = f"CASE WHEN {y} IS NOT NULL THEN {x} END", f"CASE WHEN {x} IS NOT NULL THEN {y} END"
    spread = f"stddev_pop({a}) OVER {win} * stddev_pop({b}) OVER {win}"
    return f"CASE WHEN {spread} > 1e-15 THEN covar_pop({a}, {b}) OVER {win} / ({spread}) END"


@query(over_r({f"acf1_{n}": _corr("ret", "prev_ret", f"w{n}") for n in (24, 72)}, w("w24", 24), w("w72", 72)))
def return_autocorrelation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.autocorrelation(base(spark, sf_dir)), "acf1_24", "acf1_72")


def _clip(x: str, low: float, high: float) -> str:
    return f"CASE WHEN ({x}) IS NOT NULL THEN least(greatest({x}, {low}), {high}) END"


@query(over_r({f"volume_ret_{k}": _clip(f"(volume - lag(volume, {k}) OVER o) / nullif(lag(volume, {k}) OVER o, 0)", -10, 10) for k in (1, 24)}, "o AS (PARTITION BY key ORDER BY ts)"))
def volume_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.volume_returns(base(spark, sf_dir)), "volume_ret_1", "volume_ret_24")


@query(over_r({
    "log_volume": "ln(1 + volume)", "log_volume_mean_24": "ln(1 + avg(volume) OVER h24)", "log_volume_mean_168": "ln(1 + avg(volume) OVER h168)",
    "log_volume_per_supply": "ln(1 + volume / nullif(length(key) - 4, 0))", "log_volume_mean_24_per_supply": "ln(1 + avg(volume) OVER h24 / nullif(length(key) - 4, 0))"}, hours("h24", 24), hours("h168", 168)))
def volume_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = base(spark, sf_dir).withColumn("supply", (F.length("key") - 4).cast("double"))
    return out(R.volume_levels(df, supply="supply"), "log_volume", "log_volume_mean_24", "log_volume_mean_168", "log_volume_per_supply", "log_volume_mean_24_per_supply")


VOLUME = {
    "volume_cv_24": "stddev_samp(volume) OVER h24 / nullif(avg(volume) OVER h24, 0)", "volume_cv_168": "stddev_samp(volume) OVER h168 / nullif(avg(volume) OVER h168, 0)",
    "volume_spike_24": "volume / nullif((sum(volume) OVER h24 - volume) / nullif(count(*) OVER h24 - 1, 0), 0)", "volume_z_24": _z("volume", "h24"),
    "volume_accel_6_24": "(sum(volume) OVER h6 - sum(volume) OVER h24) / nullif(sum(volume) OVER h24, 0)", "volume_accel_24_168": "(sum(volume) OVER h24 - sum(volume) OVER h168) / nullif(sum(volume) OVER h168, 0)",
}
VOLUME_WINDOWS = (hours("h6", 6), hours("h24", 24), hours("h168", 168))


@query(over_r(VOLUME, *VOLUME_WINDOWS))
def volume_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.volume_features(base(spark, sf_dir)), *VOLUME)


@query(over_r({f"volume_ema_{k}": f"sum(volume * p{k}) OVER u / nullif(sum(p{k}) OVER u, 0)" for k in ("fast", "slow")}, "u AS (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING)",
    more=", m AS (SELECT *, power(0.75, row_number() OVER (PARTITION BY key ORDER BY ts)) AS pfast, power(0.9, row_number() OVER (PARTITION BY key ORDER BY ts)) AS pslow FROM r)", source="m"))
def volume_decay_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.volume_weighted_decay(base(spark, sf_dir)), "volume_ema_fast", "volume_ema_slow")


@query(f"""WITH RECURSIVE {GRID}, n AS (SELECT key, ts, volume, row_number() OVER (PARTITION BY key ORDER BY ts) AS i FROM grid),
f AS (SELECT key, ts, i, volume AS v, 1.0::DOUBLE AS c FROM n WHERE i = 1 UNION ALL SELECT n.key, n.ts, n.i, f.v * 0.75 + n.volume, f.c * 0.75 + 1 FROM f JOIN n ON n.key = f.key AND n.i = f.i + 1)
SELECT key, ts, {r6('v / c', 'volume_ema_fast')} FROM f""")
def volume_decay_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.volume_weighted_decay(base(spark, sf_dir), {"fast": 0.75}, decay="recent"), "volume_ema_fast")


_VWAP = {n: f"sum(price * volume) OVER w{n} / nullif(sum(volume) OVER w{n}, 0)" for n in (4, 24)}


@query(over_r({f"vwap_{n}": x for n, x in _VWAP.items()} | {f"dist_vwap_{n}": f"price / nullif({x}, 0) - 1" for n, x in _VWAP.items()}, w("w4", 4), w("w24", 24)))
def volume_weighted_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.vwap(base(spark, sf_dir)), "vwap_4", "vwap_24", "dist_vwap_4", "dist_vwap_24")


LIQUIDITY = {
    "amihud_24": "avg(abs(coalesce(ret, 0)) / nullif(volume, 0)) OVER w24", "dollar_amihud_24": "avg(abs(coalesce(ret, 0)) / nullif(dollar_volume, 0)) OVER w24",
    "spread_bps_24": "CASE WHEN covar_samp(coalesce(ret, 0), prev_ret) OVER w24 < 0 THEN 2 * sqrt(-(covar_samp(coalesce(ret, 0), prev_ret) OVER w24)) * 10000 ELSE 0 END", "dollar_volume_24": "sum(dollar_volume) OVER w24",
    "dollar_volume_cv_24": "stddev_samp(dollar_volume) OVER w24 / nullif(avg(dollar_volume) OVER w24, 0)", "dollar_volume_min_24": "min(dollar_volume) OVER w24",
    "dollar_volume_p10_24": "list_sort(list(dollar_volume) OVER w24)[CAST(floor((count(*) OVER w24 - 1) * 0.1) AS INT) + 1]",
}


@query(over_r(LIQUIDITY, w("w24", 24)))
def liquidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.liquidity(base(spark, sf_dir)), *LIQUIDITY)


def trend_sql(n: int) -> dict[str, str]:
    full = f"count(*) OVER w{n} = {n}"
    return {
        f"trend_slope_{n}": f"CASE WHEN {full} THEN covar_pop(ln(price), i) OVER w{n} / nullif(var_pop(i) OVER w{n}, 0) END",
        f"trend_r2_{n}": f"CASE WHEN {full} THEN CASE WHEN var_pop(ln(price)) OVER w{n} * {n} > 1e-12 THEN least(power(covar_pop(ln(price), i) OVER w{n}, 2) / (var_pop(i) OVER w{n} * var_pop(ln(price)) OVER w{n}), 1.0) ELSE 0 END END",
    }


_INDEXED = ", m AS (SELECT *, CAST(row_number() OVER (PARTITION BY key ORDER BY ts) AS DOUBLE) AS i FROM r)"


@query(over_r(trend_sql(24) | trend_sql(168), w("w24", 24), w("w168", 168), more=_INDEXED, source="m", ctes=DAILY_RETURNS))
def daily_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.ols_trend(R.log_price(daily_base(spark, sf_dir)), (24, 168)), *trend_sql(24), *trend_sql(168))


@query(over_r(trend_sql(24) | trend_sql(168), w("w24", 24), w("w168", 168), more=_INDEXED, source="m"))
def log_price_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.ols_trend(R.log_price(base(spark, sf_dir)), (24, 168)), *trend_sql(24), *trend_sql(168))


_TREND = f", m AS (SELECT *, CAST(row_number() OVER (PARTITION BY key ORDER BY ts) AS DOUBLE) AS i FROM r), t AS (SELECT key, ts, {', '.join(f'{x} AS {n}' for n, x in trend_sql(24).items())} FROM m WINDOW {w('w24', 24)})"
_T24 = "CASE WHEN trend_r2_24 < 1 THEN sign(trend_slope_24) * sqrt(22 * trend_r2_24 / nullif(1 - trend_r2_24, 0)) END"
_SPEED = f"CASE WHEN trend_r2_24 >= 1e-6 THEN exp({_clip('24 * trend_slope_24', -20, 20)}) - 1 END"


@query(f"WITH {RETURNS}{_TREND} SELECT key, ts, {r6(_T24, 'trend_t_24')}, {r6(_SPEED, 'trend_speed_24')}, CASE WHEN abs({_T24}) < 2 THEN 'flat' WHEN ({_SPEED}) > 0 THEN 'up' WHEN ({_SPEED}) < 0 THEN 'down' END AS trend_state_24, {r6(f'({_SPEED}) * trend_r2_24', 'trend_score_24')} FROM t")
def trend_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.trend_state(R.ols_trend(R.log_price(base(spark, sf_dir)), (24,)), 24), "trend_t_24", "trend_speed_24", "trend_state_24", "trend_score_24")


_CUM = ", m AS (SELECT *, sum(lr) OVER (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING) AS c, row_number() OVER (PARTITION BY key ORDER BY ts) AS i FROM r)"


@query(over_r({"log_gap_high_240": "CASE WHEN count(*) OVER w = 240 THEN c - max(c) OVER w END", "log_gap_low_240": "CASE WHEN count(*) OVER w = 240 THEN c - min(c) OVER w END"}, w("w", 240), more=_CUM, source="m"))
def log_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.log_gaps(base(spark, sf_dir), 240), "log_gap_high_240", "log_gap_low_240")


@query(over_r({k: v for n in (24, 168) for k, v in {f"bollinger_width_{n}": f"2 * stddev_samp(price) OVER w{n} / nullif(avg(price) OVER w{n}, 0)", f"donchian_width_{n}": f"(max(price) OVER w{n} - min(price) OVER w{n}) / nullif(avg(price) OVER w{n}, 0)"}.items()}, w("w24", 24), w("w168", 168)))
def band_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.band_widths(base(spark, sf_dir)), "bollinger_width_24", "donchian_width_24", "bollinger_width_168", "donchian_width_168")


_UP, _DOWN = "sum(CASE WHEN ret > 0 THEN 1 ELSE 0 END) OVER w", "sum(CASE WHEN ret < 0 THEN 1 ELSE 0 END) OVER w"


@query(f"WITH {RETURNS} SELECT key, ts, CAST({_UP} AS BIGINT) AS up_count_24, CAST({_DOWN} AS BIGINT) AS down_count_24, {r6(f'({_UP} - {_DOWN}) / 24.0', 'momentum_run_24')}, {r6(_clip('sum(abs(logret)) OVER w / nullif(abs(sum(logret) OVER w), 0)', 0, 100), 'chop_24')} FROM r WINDOW {w('w', 24)}")
def persistence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.persistence(base(spark, sf_dir), (24,)), "up_count_24", "down_count_24", "momentum_run_24", "chop_24")


_M = [f"avg(power(lr, {k})) OVER w" for k in (1, 2, 3)]


@query(over_r({"skew_168": f"CASE WHEN count(*) OVER w = 168 THEN {_clip(f'CASE WHEN {_M[1]} - power({_M[0]}, 2) > 1e-18 THEN ({_M[2]} - 3 * {_M[0]} * {_M[1]} + 2 * power({_M[0]}, 3)) / power({_M[1]} - power({_M[0]}, 2), 1.5) END', -10, 10)} END"}, w("w", 168)))
def return_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.skewness(base(spark, sf_dir)), "skew_168")


_REF = ", ref AS (SELECT ts, ret AS ref_ret, logret AS ref_logret, lr AS ref_lr FROM r WHERE key = 'view'), m AS (SELECT r.*, ref_ret, ref_lr FROM r LEFT JOIN ref USING (ts))"
_X, _Y = "CASE WHEN ret IS NOT NULL THEN ref_ret END", "CASE WHEN ref_ret IS NOT NULL THEN ret END"
_BETA = f"(avg(({_X}) * ({_Y})) OVER w - avg({_X}) OVER w * avg({_Y}) OVER w) / nullif(power(stddev_samp({_X}) OVER w, 2), 0)"


def with_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = base(spark, sf_dir)
    ref = df.where("key = 'view'").select("ts", F.col("ret").alias("ref_ret"), F.coalesce("logret", F.lit(0.0)).alias("ref_lr"))
    return df.join(ref, "ts", "left")


@query(over_r({"beta_72": _BETA, "alpha_72": f"ret - ({_BETA}) * ref_ret", "spread_sum_72": f"sum(({_Y}) - ({_X})) OVER w"}, w("w", 72), more=_REF, source="m"))
def beta_to_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.beta_to(with_reference(spark, sf_dir), "ref_ret"), "beta_72", "alpha_72", "spread_sum_72")


@query(over_r({"ret_volume_corr_72": _corr("ret", "volume", "w")}, w("w", 72)))
def return_volume_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.return_volume_correlation(base(spark, sf_dir)), "ret_volume_corr_72")


_PI = "3.141592653589793"


@query(f"""WITH {GRID} SELECT key, ts, CAST(hour(ts) AS DOUBLE) AS hour_of_day, CAST(dayofweek(ts) + 1 AS DOUBLE) AS day_of_week, {r6(f'sin(2 * {_PI} * hour(ts) / 24)', 'sin_hour')}, {r6(f'cos(2 * {_PI} * hour(ts) / 24)', 'cos_hour')},
{r6(f'sin(2 * {_PI} * (dayofweek(ts) + 1) / 7)', 'sin_day')}, {r6(f'cos(2 * {_PI} * (dayofweek(ts) + 1) / 7)', 'cos_day')}, CASE WHEN dayofweek(ts) IN (0, 6) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_weekend FROM grid""")
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.calendar(grid(spark, sf_dir)), "hour_of_day", "day_of_week", "sin_hour", "cos_hour", "sin_day", "cos_day", "is_weekend")


_RV24, _RV168 = "(sqrt(sum(lr * lr) OVER w24) * sqrt(24))", "(sqrt(sum(lr * lr) OVER w168) * sqrt(24))"


@query(over_r({"vol_ratio_24_168": f"{_RV24} / nullif({_RV168}, 0)", "ret_over_rv_24": f"ret / nullif({_RV24}, 0)", "rsi_vol": f"coalesce(({_rsi(14)}) * ({_RV24} / nullif({_RV168}, 0)) / 100, 0)"}, w("w14", 14), w("w24", 24), w("w168", 168)))
def volatility_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.ratios(R.rsi(R.realized_vol(base(spark, sf_dir), (24, 168)))), "vol_ratio_24_168", "ret_over_rv_24", "rsi_vol")


@query(f"WITH {RETURNS} SELECT key, ts, {', '.join(f'count(ret) OVER w{n} = {n} AS has_{n}, {n} - count(ret) OVER w{n} AS missing_{n}' for n in (24, 72, 168))} FROM r WINDOW {', '.join(w(f'w{n}', n) for n in (24, 72, 168))}")
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.completeness(base(spark, sf_dir)), *[f"{p}_{n}" for n in (24, 72, 168) for p in ("has", "missing")])


_DV = "sum(dollar_volume) OVER w24"
_FEE = "least(exp(-0.371 + 0.573 * ln(250.0) + 0.424 * ln(greatest(250.0 / greatest(dv, 1.0), 1e-10)) + 0.218 * ln(greatest(dv / 5000.0, 1e-10)) + 0.149 * ln(greatest(dv, 1.0)) - 0.069 * ln(5000.0)) / 250.0 * 10000, 500.0)"


@query(f"WITH {RETURNS}, m AS (SELECT key, ts, 2000 * {_DV} AS dv FROM r WINDOW {w('w24', 24)}) SELECT key, ts, {r6(_FEE, 'fee_bps')}, CASE WHEN 250.0 / greatest(dv, 1.0) > 0.005 THEN 300.0::DOUBLE WHEN 250.0 / greatest(dv, 1.0) > 0.0005 THEN 50.0::DOUBLE ELSE 10.0::DOUBLE END AS slippage_bps FROM m")
def trading_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.cost_model(R.liquidity(base(spark, sf_dir).withColumn("volume", 2000 * F.col("volume"))).withColumn("mktcap", F.lit(5000.0))), "fee_bps", "slippage_bps")


@query(over_r({"slippage_vol_bps": f"least(greatest({_RV24} * 50, 5), 300)"}, w("w24", 24)))
def volatility_slippage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.volatility_slippage(R.realized_vol(base(spark, sf_dir), (24,)), factor=50.0), "slippage_vol_bps")


@query(f"WITH {GRID}, m AS (SELECT key, ts, price, lead(price) OVER (PARTITION BY key ORDER BY ts) AS next_price FROM grid) SELECT key, ts, {r6('price', 'price')}, {r6('next_price', 'next_price')} FROM m WHERE next_price IS NOT NULL")
def next_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.next_bar(grid(spark, sf_dir), keep_edge=False), "price", "next_price")


ACTIVITY = {
    "volume_growth": "(volume - lag(volume) OVER o) / nullif(lag(volume) OVER o, 0)", "volume_log_growth": "CASE WHEN volume > 0 AND lag(volume) OVER o > 0 THEN ln(volume / lag(volume) OVER o) END", "volume_rel_mean": "volume / nullif(avg(volume) OVER w168, 0)",
    "volume_rel_std": "stddev_samp(volume) OVER w168 / nullif(avg(volume) OVER w168, 0)", "volume_share": "volume / nullif(sum(volume) OVER w168, 0)", "volume_z": _z("volume", "w168"), "volume_drawdown": "volume / nullif(max(volume) OVER w168, 0) - 1",
    "volume_vol_ratio": "stddev_samp(volume) OVER w24 / nullif(stddev_samp(volume) OVER w168, 0)",
}


@query(over_r(ACTIVITY, "o AS (PARTITION BY key ORDER BY ts)", w("w24", 24), w("w168", 168)))
def activity_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.activity_features(base(spark, sf_dir), ["volume"]), *ACTIVITY)


_SHORT = (4, 6, 12, 24, 72)
RATIOS = (
    {f"volume_growth_{n}": f"volume / nullif(lag(volume, {n}) OVER o, 0) - 1" for n in (6, 24)}
    | {f"volume_rel_{name}_{n}": f"{f}(volume) OVER w{n} / nullif({f}(volume) OVER w168, 0)" for n in _SHORT for name, f in (("mean", "avg"), ("std", "stddev_samp"), ("cum", "sum"))}
    | {f"volume_sharpe_{n}": f"avg(volume) OVER w{n} / nullif(stddev_samp(volume) OVER w{n}, 0)" for n in (4, 6, 12, 24)}
    | {f"volume_z_{n}": f"(volume - avg(volume) OVER w{n}) / nullif(stddev_samp(volume) OVER w{n}, 0)" for n in (6, 12, 24)}
    | {f"volume_vol_ratio_{a}_{b}": f"stddev_samp(volume) OVER w{a} / nullif(stddev_samp(volume) OVER w{b}, 0)" for a, b in ((6, 24), (12, 72), (24, 168))}
)


@query(over_r(RATIOS, "o AS (PARTITION BY key ORDER BY ts)", *[w(f"w{n}", n) for n in (*_SHORT, 168)], ctes=DAILY_RETURNS))
def activity_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.activity_ratios(daily_grid(spark, sf_dir).select("key", "ts", "volume"), ["volume"]), *RATIOS)


@query(over_r({"volume_acf1_24": _corr("volume", "vb", "h24")}, hours("h24", 24), more=", m AS (SELECT *, lag(volume) OVER (PARTITION BY key ORDER BY ts) AS vb FROM r)", source="m"))
def volume_autocorrelation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.volume_autocorrelation(base(spark, sf_dir)), "volume_acf1_24")


@query(f"WITH {HOURLY} SELECT key, ts, CAST(row_number() OVER (PARTITION BY key ORDER BY ts) AS INT) AS age_rows, CAST(date_diff('day', CAST(min(ts) OVER (PARTITION BY key) AS DATE), CAST(ts AS DATE)) AS INT) AS age_days FROM bars")
def series_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.age(hourly(spark, sf_dir)), "age_rows", "age_days")


HORIZON = {
    "cumret_96": "CASE WHEN i >= 96 THEN exp(sum(lr) OVER w96) - 1 END", "drawdown_96": "CASE WHEN i >= 96 THEN price / nullif(max(price) OVER w96, 0) - 1 END", "dist_sma_96": "CASE WHEN i >= 96 THEN price / nullif(avg(price) OVER w96, 0) - 1 END",
    "log_gap_high_480": "CASE WHEN i >= 480 THEN c - max(c) OVER w480 END", "log_gap_record": "c - max(c) OVER u", "record_age": "CASE WHEN i > 1 THEN (i - max(CASE WHEN price >= record THEN i END) OVER u) / (i - 1.0) END",
}
_RECORD = _CUM + ", n AS (SELECT *, max(price) OVER (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING) AS record FROM m)"


@query(over_r(HORIZON, w("w96", 96), w("w480", 480), "u AS (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING)", more=_RECORD, source="n"))
def long_horizons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.horizons(base(spark, sf_dir), (96,), 480), *HORIZON)


_QUALITY = f", m AS (SELECT *, price / nullif(max(price) OVER w168, 0) - 1 AS dd, {VOLUME['volume_z_24']} AS vz, exp(sum(lr) OVER w24) - 1 AS c24, exp(sum(lr) OVER w168) - 1 AS c168 FROM r WINDOW {hours('h24', 24)}, {w('w24', 24)}, {w('w168', 168)})"


@query(over_r({
    "pullback_z": f"CASE WHEN count(*) OVER w240 = 240 THEN {_z('dd', 'w240')} END", "volume_momentum_align": f"CASE WHEN count(*) OVER w168 = 168 THEN {_clip(_corr('lr', 'vz', 'w168'), -1, 1)} END",
    "up_bar_share": "CASE WHEN count(*) OVER w72 = 72 THEN avg(CASE WHEN logret > 0 THEN 1.0 ELSE 0.0 END) OVER w72 END", "momentum_accel": "c24 - c168 * 24 / 168"}, w("w72", 72), w("w168", 168), w("w240", 240), more=_QUALITY, source="m"))
def quality_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = R.cumulative_return(R.volume_features(R.extremes(base(spark, sf_dir), (168,))))
    return out(R.quality_features(df, pullback=240), "pullback_z", "volume_momentum_align", "up_bar_share", "momentum_accel")


_IDIO = _REF + f", k AS (SELECT *, exp(sum(lr) OVER w168) - 1 AS c168, exp(sum(ref_lr) OVER w168) - 1 AS rc168 FROM m WINDOW {w('w168', 168)})"
_IB = _clip("covar_pop(lr, ref_lr) OVER w / nullif(var_pop(ref_lr) OVER w, 0)", -2, 5)
_IC = _corr("lr", "ref_lr", "w")


@query(over_r({"idio_beta": f"CASE WHEN count(*) OVER w = 240 THEN {_IB} END", "idio_momentum": f"c168 - (CASE WHEN count(*) OVER w = 240 THEN {_IB} END) * rc168", "idio_share": f"CASE WHEN count(*) OVER w = 240 THEN {_clip(f'1 - power({_IC}, 2)', 0, 1)} END"}, w("w", 240), more=_IDIO, source="k"))
def idiosyncratic_momentum(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_reference(spark, sf_dir)
    df = R.cumulative_return(df, (168,)).withColumn("ref_cumret", F.exp(F.sum("ref_lr").over(R.S.rows(168))) - 1)
    return out(R.idiosyncratic(df, "ref_lr", "ref_cumret", n=240), "idio_beta", "idio_momentum", "idio_share")


_DORMANT = f", m AS (SELECT *, {VOLUME['volume_z_24']} AS vz, row_number() OVER (PARTITION BY key ORDER BY ts) AS i FROM r WINDOW {hours('h24', 24)}), n AS (SELECT *, ln(1 + (i - coalesce(max(CASE WHEN vz >= 2 THEN i END) OVER (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING), 0)) / 24.0) AS d FROM m)"


@query(over_r({"dormancy": "d", "reawakening": "CASE WHEN vz IS NOT NULL THEN d * greatest(vz, 0) END"}, more=_DORMANT, source="n"))
def dormancy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.dormancy(R.volume_features(base(spark, sf_dir))), "dormancy", "reawakening")


_VPIN = f", m AS (SELECT *, abs(tanh(0.851 * lr / nullif(stddev_samp(ret) OVER w24, 0))) * dollar_volume AS tox FROM r WINDOW {w('w24', 24)}), n AS (SELECT *, CASE WHEN count(*) OVER w24 = 24 THEN sum(tox) OVER w24 / nullif(sum(dollar_volume) OVER w24, 0) END AS v24, CASE WHEN count(*) OVER w168 = 168 THEN sum(tox) OVER w168 / nullif(sum(dollar_volume) OVER w168, 0) END AS v168 FROM m WINDOW {w('w24', 24)}, {w('w168', 168)})"


@query(over_r({"vpin_24": "v24", "vpin_168": "v168", "vpin_z": f"CASE WHEN count(*) OVER w240 = 240 THEN {_z('v24', 'w240')} END"}, w("w240", 240), more=_VPIN, source="n"))
def volume_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.vpin(R.mean_std(base(spark, sf_dir), (24,)), z=240), "vpin_24", "vpin_168", "vpin_z")


_JUMP = ", m AS (SELECT *, lr * lr AS r2, abs(lr) * abs(lag(lr) OVER (PARTITION BY key ORDER BY ts)) AS bp, CASE WHEN lr < 0 THEN lr * lr ELSE 0 END AS dn, row_number() OVER (PARTITION BY key ORDER BY ts) AS i FROM r)"


@query(over_r({k: v for n in (24, 168) for k, v in {
    f"jump_share_{n}": f"CASE WHEN i > {n} THEN greatest(sum(r2) OVER w{n} - pi() / 2 * sum(bp) OVER w{n}, 0) / nullif(sum(r2) OVER w{n}, 0) END",
    f"down_share_{n}": f"CASE WHEN count(*) OVER w{n} = {n} THEN sum(dn) OVER w{n} / nullif(sum(r2) OVER w{n}, 0) END"}.items()}, w("w24", 24), w("w168", 168), more=_JUMP, source="m"))
def jump_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(R.jumps(base(spark, sf_dir)), "jump_share_24", "down_share_24", "jump_share_168", "down_share_168")


FLAGSHIP = {"price": "price", "volume": "volume", "ret": "ret", "logret": "logret", "cumret_24": "exp(sum(lr) OVER w24) - 1", "breakout_high_24": "CASE WHEN price > max(price) OVER p24 THEN 1.0 ELSE 0.0 END"}


@query(f"WITH {RETURNS} SELECT key, ts, {', '.join(r6(x, n) for n, x in FLAGSHIP.items())}, count(ret) OVER w24 = 24 AS has_24 FROM r WINDOW {w('w24', 24)}, {prior('p24', 24)}")
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks to hourly bars, a filled grid, returns, cumulative returns, breakouts and completeness."""
    df = R.completeness(R.breakouts(R.cumulative_return(base(spark, sf_dir), (24,))), (24,))
    return out(df, *FLAGSHIP, "has_24")


_ONE = TICKS + """,
one AS (SELECT event_id, ts, price, volume, sum(volume) OVER o AS total, max(price) OVER o AS record, row_number() OVER o AS i FROM ticks WINDOW o AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""
_ONE_FRAMES = {"mean_500": "avg(price) OVER w500", "std_500": "stddev_samp(price) OVER w500", "high_2000": "max(price) OVER w2000", "low_2000": "min(price) OVER w2000", "place_500": "CASE WHEN i >= 500 THEN list_count(list_filter(list(price) OVER w500, lambda v: v <= price)) / 500 END"}


@query(f"""WITH {_ONE} SELECT event_id, ts, {', '.join(r6(v, k) for k, v in _ONE_FRAMES.items())}, {r6('total', 'total')}, {r6('record', 'record')} FROM one
WINDOW w500 AS (ORDER BY ts, event_id ROWS BETWEEN 499 PRECEDING AND CURRENT ROW), w2000 AS (ORDER BY ts, event_id ROWS BETWEEN 1999 PRECEDING AND CURRENT ROW)""")
def one_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ticks as one series, which is split over tasks by blocks with halos; running values go on from chunk to chunk."""
    wanted = [Frame("mean_500", "price", 500, "mean"), Frame("std_500", "price", 500, "std"), Frame("high_2000", "price", 2000, "max"), Frame("low_2000", "price", 2000, "min"), Frame("place_500", "price", 500, "share_at_most")]
    s = R.Series("series", "ts")
    rows = running(ticks(spark, sf_dir).withColumn("series", F.lit(0)), {"total": "volume"}, {"record": "price"}, s, ["event_id"])
    rows = add_frames(rows, wanted, s, ["event_id"], split=5000)
    return rounded(rows.select("event_id", "ts", *_ONE_FRAMES, "total", "record"))
