"""Queries over sessions, labels, averages, trades, levels, patterns and the universe."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.expr import rounded
from barloom.operators import ema as E
from barloom.operators import labels as L
from barloom.operators import levels as V
from barloom.operators import patterns as P
from barloom.operators import rolling as R
from barloom.operators import sketches as K
from barloom.operators import sampling as A
from barloom.operators import sessions as Z
from barloom.operators import trades as T
from barloom.operators import universe as U
from barloom.plans.adapters import DAILY, GRID, HOURLY, RETURNS, SHAPED, USER_TICKS, daily, grid, hourly, load, r6, shaped, user_ticks, w
from barloom.plans.registry import query
from barloom.plans.series import base, out

O = "(PARTITION BY key ORDER BY ts)"
PAST = "(PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING)"

SESSIONS = GRID + f""",
s1 AS (SELECT *, max(CASE WHEN price > 300 THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY ts RANGE BETWEEN INTERVAL 4 HOUR PRECEDING AND CURRENT ROW) = 1 AS monitored FROM grid),
s2 AS (SELECT *, CASE WHEN monitored AND NOT coalesce(lag(monitored) OVER {O}, false) THEN 1 ELSE 0 END AS st FROM s1),
s3 AS (SELECT key, ts, price, monitored, CASE WHEN monitored THEN CAST(sum(st) OVER {PAST} AS BIGINT) END AS session FROM s2)"""


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.sessionize(grid(spark, sf_dir), F.col("price") > 300, 4 * 3600)


@query(f"WITH {SESSIONS} SELECT key, ts, monitored, session FROM s3")
def monitoring_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions(spark, sf_dir).select("key", "ts", "monitored", "session")


@query(f"""WITH {GRID}, a AS (SELECT *, price > 300 AS f, coalesce(lag(price > 300) OVER {O}, false) AS pf FROM grid), b AS (SELECT *, last_value(CASE WHEN NOT f AND pf THEN ts END IGNORE NULLS) OVER {PAST} AS d FROM a),
c AS (SELECT *, timezone('Europe/Paris', timezone('UTC', d)) AS local FROM b),
e AS (SELECT *, timezone('UTC', timezone('Europe/Paris', CAST(CASE WHEN hour(local) < 7 THEN CAST(local AS DATE) ELSE CAST(local AS DATE) + 1 END AS TIMESTAMP) + INTERVAL 7 HOUR)) AS until FROM c),
g AS (SELECT *, f OR (d IS NOT NULL AND ts < until) AS monitored FROM e), h AS (SELECT *, CASE WHEN monitored AND NOT coalesce(lag(monitored) OVER {O}, false) THEN 1 ELSE 0 END AS st FROM g)
SELECT key, ts, monitored, CASE WHEN monitored THEN CAST(sum(st) OVER {PAST} AS BIGINT) END AS session FROM h""")
def local_hour_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.sessionize_until_local_hour(grid(spark, sf_dir), F.col("price") > 300).select("key", "ts", "monitored", "session")


EXTENDED = SESSIONS + """,
bo AS (SELECT key, session, min(ts) AS a, max(ts) AS b FROM s3 WHERE session IS NOT NULL GROUP BY key, session),
ca AS (SELECT s3.key, s3.ts, s3.price, bo.session, bo.a, bo.b, s3.ts < a AS in_pre, s3.ts BETWEEN a AND b AS in_core, s3.ts > b AS in_post, greatest(epoch(a) - epoch(s3.ts), epoch(s3.ts) - epoch(b), 0) AS away
  FROM s3 JOIN bo ON bo.key = s3.key AND s3.ts BETWEEN a - INTERVAL 1 DAY AND b + INTERVAL 1 DAY),
ex AS (SELECT * FROM ca QUALIFY row_number() OVER (PARTITION BY key, ts ORDER BY CASE WHEN in_core THEN 0 ELSE 1 END, away, session) = 1)"""


def extended(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Z.extend_sessions(sessions(spark, sf_dir), 1, 1)


@query(f"WITH {EXTENDED} SELECT key, ts, session, a AS session_start, b AS session_end, a - INTERVAL 1 DAY AS extended_start, b + INTERVAL 1 DAY AS extended_end, in_pre, in_core, in_post FROM ex")
def extended_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extended(spark, sf_dir).select("key", "ts", "session", "session_start", "session_end", "extended_start", "extended_end", "in_pre", "in_core", "in_post")


PATHS = GRID + """,
la AS (SELECT key, max(ts) AS last FROM grid GROUP BY key),
en AS (SELECT g.key, g.ts AS entry_ts FROM grid g JOIN la USING (key) WHERE hour(g.ts) % 6 = 0 AND g.ts + INTERVAL 72 HOUR <= last),
pa AS (SELECT en.key, entry_ts, CAST((epoch(g.ts) - epoch(entry_ts)) / 3600 AS BIGINT) AS h, g.price FROM en JOIN grid g ON g.key = en.key AND g.ts >= entry_ts AND g.ts <= entry_ts + INTERVAL 72 HOUR)"""


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.forward_paths(grid(spark, sf_dir), F.hour("ts") % 6 == 0)


@query(f"WITH {PATHS} SELECT key, entry_ts, h, {r6('price', 'price')} FROM pa")
def forward_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(paths(spark, sf_dir))


_PW = "(PARTITION BY key, entry_ts ORDER BY h)"
SUMMARY = PATHS + f""",
q1 AS (SELECT *, max(CASE WHEN h = 0 THEN price END) OVER (PARTITION BY key, entry_ts) AS p0, lag(price) OVER {_PW} AS pb, max(price) OVER (PARTITION BY key, entry_ts ORDER BY h ROWS UNBOUNDED PRECEDING) AS pk FROM pa),
q2 AS (SELECT *, price / nullif(p0, 0) - 1 AS cr, CASE WHEN price > 0 AND pb > 0 THEN ln(price / pb) END AS lr FROM q1)"""
_UP, _DOWN = (0.10, 0.50, 1.00, 5.00), (0.10, 0.30, 0.50)
_SUM_DOUBLES = {
    "price0": "max(p0)", **{f"ret_{c}h": f"coalesce(max(CASE WHEN h = {c} THEN cr END), 0)" for c in (8, 24, 48, 72)}, "max_gain": "coalesce(max(cr), 0)", "max_drawdown": "coalesce(min(price / nullif(pk, 0) - 1), 0)",
    "rv": "sqrt(sum(coalesce(lr * lr, 0))) * sqrt(24)", "std_logret": "coalesce(stddev_samp(lr), 0)", "mean_logret": "coalesce(avg(lr), 0)", "p95_abs_logret": "coalesce(quantile_cont(abs(lr), 0.95), 0)",
    "share_up": "coalesce(count(CASE WHEN lr > 0 THEN 1 END) / nullif(count(lr), 0)::DOUBLE, 0)", "sharpe": "coalesce(avg(lr) / nullif(stddev_samp(lr), 0) * sqrt(24), 0)",
    "log_slope": "coalesce(covar_samp(ln(price), h) / nullif(var_samp(h), 0), 0)", "log_r2": "coalesce(power(corr(h, ln(price)), 2), 0)", "mean_cumret": "coalesce(avg(cr), 0)",
    **{f"mean_cumret_{a}_{b}h": f"coalesce(avg(CASE WHEN h BETWEEN {a} AND {b} THEN cr END), 0)" for a, b in ((0, 8), (8, 24), (24, 48), (48, 72))},
}
_SUM_INTS = {f"t_up_{round(x * 100)}": f"CAST(coalesce(min(CASE WHEN cr >= {x} THEN h END), 200) AS BIGINT)" for x in _UP} | {f"t_down_{round(x * 100)}": f"CAST(coalesce(min(CASE WHEN cr <= -{x} THEN h END), 200) AS BIGINT)" for x in _DOWN}


@query(f"""WITH {SUMMARY} SELECT key, entry_ts, count(*) AS n_points, max(h) AS max_h, {', '.join(f'{x} AS {n}' for n, x in _SUM_INTS.items())}, {', '.join(r6(x, n) for n, x in _SUM_DOUBLES.items())},
arg_max(h, price * 1e6 - h) AS peak_h, arg_min(h, price * 1e6 + h) AS trough_h, CASE WHEN count(*) >= 73 AND max(h) = 72 THEN 1 ELSE 0 END AS is_full FROM q2 GROUP BY key, entry_ts""")
def path_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(L.path_summary(paths(spark, sf_dir), up=_UP, down=_DOWN))


@query(f"""WITH {SUMMARY}, t AS (SELECT key, entry_ts, min(CASE WHEN cr >= 0.5 THEN h END) AS u, min(CASE WHEN cr <= -0.3 THEN h END) AS d FROM q2 GROUP BY key, entry_ts)
SELECT key, entry_ts, CASE WHEN least(coalesce(u, 75), 75) < 75 AND least(coalesce(u, 75), 75) < least(coalesce(d, 75), 75) THEN 1 ELSE 0 END AS label FROM t""")
def first_passage_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.first_passage_label(L.path_summary(paths(spark, sf_dir), up=(0.5,), down=(0.3,)), 0.5, 0.3).select("key", "entry_ts", "label")


def _trend(n: int) -> str:
    inside = f"h <= {n}"
    full = f"count(CASE WHEN {inside} THEN 1 END) >= {n + 1}"
    x, y = f"CASE WHEN {inside} THEN h END", f"CASE WHEN {inside} THEN ln(price) END"
    return f"""CASE WHEN {full} THEN 1 ELSE 0 END AS full_{n}, CASE WHEN {full} THEN ln(max(CASE WHEN h = {n} THEN price END) / max(p0)) END AS fwd_{n},
    CASE WHEN {full} THEN power(covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0), 2) END AS r2_{n}, CASE WHEN {full} THEN ln(max(CASE WHEN {inside} THEN price END) / max(p0)) END AS mfe_{n}, CASE WHEN {full} THEN ln(min(CASE WHEN {inside} THEN price END) / max(p0)) END AS mae_{n}"""


def _trend_label(n: int, least: float, r2: float, worst: float) -> str:
    return f"CASE WHEN fwd_{n} >= {least} AND r2_{n} >= {r2} AND mae_{n} >= {worst} THEN 1 WHEN fwd_{n} <= -{least} AND r2_{n} >= {r2} AND mfe_{n} <= {-worst} THEN -1 ELSE 0 END"


@query(f"""WITH {SUMMARY}, t AS (SELECT key, entry_ts, max(p0) AS price0, {_trend(8)}, {_trend(72)} FROM q2 GROUP BY key, entry_ts)
SELECT key, entry_ts, {r6('price0', 'price0')}, {', '.join(f"full_{n} AS full_{m}, {r6(f'fwd_{n}', f'fwd_{m}')}, {r6(f'r2_{n}', f'r2_{m}')}, {r6(f'mfe_{n}', f'mfe_{m}')}, {r6(f'mae_{n}', f'mae_{m}')}" for n, m in ((8, 'entry'), (72, 'manage')))},
{_trend_label(8, 0.02, 0.1, -2.0)} AS label_entry, {_trend_label(72, 0.05, 0.01, -3.0)} AS label_manage FROM t""")
def two_horizon_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(L.trend_labels(paths(spark, sf_dir), (("entry", 8, 0.02, 0.1, -2.0), ("manage", 72, 0.05, 0.01, -3.0))))


_T = ", ".join(f"coalesce(min(CASE WHEN cr >= {x} THEN h END), 200) AS u{round(x * 100)}" for x in L.UP[:12]) + ", " + ", ".join(f"coalesce(min(CASE WHEN cr <= -{x} THEN h END), 200) AS d{round(x * 100)}" for x in L.DOWN)


@query(f"WITH {SUMMARY}, t AS (SELECT key, entry_ts, {_T} FROM q2 GROUP BY key, entry_ts) " + " UNION ALL ".join(
    f"SELECT {round(u * 100)} AS up_threshold, " + ", ".join(f"CAST(sum(CASE WHEN u{round(u * 100)} < d{round(d * 100)} AND u{round(u * 100)} < 200 THEN 1 ELSE 0 END) AS BIGINT) AS before_down_{round(d * 100)}" for d in L.DOWN) + " FROM t" for u in L.UP[:12]))
def profit_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.profit_matrix(L.path_summary(paths(spark, sf_dir)))


@query(f"""WITH {SUMMARY}, t AS (SELECT key, entry_ts, min(CASE WHEN cr >= 0.5 THEN h END) AS u, min(CASE WHEN cr <= -0.3 THEN h END) AS d FROM q2 GROUP BY key, entry_ts),
lb AS (SELECT key, entry_ts AS ts, CASE WHEN u IS NOT NULL AND u < 75 AND u < coalesce(d, 75) THEN 1 ELSE 0 END AS label FROM t),
rr AS (SELECT g.key, g.ts, g.price / nullif(lag(g.price) OVER {O}, 0) - 1 AS ret, g.price FROM grid g), ft AS (SELECT *, count(ret) OVER w24 AS n FROM rr WINDOW {w('w24', 24)}), ref AS (SELECT ts, price AS ref_price FROM grid WHERE key = 'view')
SELECT ft.key, ft.ts, {r6('ret', 'ret')}, label, {r6('ref_price', 'ref_price')} FROM ft JOIN lb ON lb.key = ft.key AND lb.ts = ft.ts LEFT JOIN ref ON ref.ts = ft.ts WHERE n = 24""")
def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = R.completeness(base(spark, sf_dir), (24,))
    labels = L.first_passage_label(L.path_summary(paths(spark, sf_dir), up=(0.5,), down=(0.3,)), 0.5, 0.3).select("key", "entry_ts", "label")
    ref = df.where("key = 'view'").select("ts", F.col("price").alias("ref_price"))
    return out(L.training_set(df, labels.union(labels), complete=F.col("has_24"), blocks=[(ref, ["ts"])]), "ret", "label", "ref_price")


@query(f"""WITH {HOURLY}, e AS (SELECT key, ts AS entry_ts, close AS entry_price FROM bars WHERE hour(ts) = 8), f AS (SELECT e.*, b.high, b.low, row_number() OVER (PARTITION BY e.key, entry_ts ORDER BY b.ts) AS i FROM e JOIN bars b ON b.key = e.key AND b.ts > entry_ts AND b.ts <= entry_ts + INTERVAL 24 HOUR),
g AS (SELECT key, entry_ts, min(CASE WHEN high >= entry_price * 1.5 THEN i END) AS target_bar, min(CASE WHEN low <= entry_price * 0.5 THEN i END) AS stop_bar FROM f GROUP BY key, entry_ts)
SELECT e.key, e.entry_ts, {r6('entry_price', 'entry_price')}, CAST(target_bar AS INT) AS target_bar, CAST(stop_bar AS INT) AS stop_bar, CASE WHEN target_bar IS NOT NULL AND (stop_bar IS NULL OR target_bar < stop_bar) THEN 1 ELSE 0 END AS label FROM e LEFT JOIN g USING (key, entry_ts)""")
def target_before_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir)
    entries = b.where(F.hour("ts") == 8).select("key", F.col("ts").alias("entry_ts"), F.col("close").alias("entry_price"))
    return rounded(L.target_before_stop(entries, b, 0.5, 0.5, 24))


@query(f"""WITH {HOURLY}, a AS (SELECT key, TIMESTAMP '2024-01-15 12:00:00' AS acquired_ts FROM bars GROUP BY key), p AS (SELECT a.key, acquired_ts, ts, close FROM a JOIN bars USING (key) WHERE ts BETWEEN acquired_ts - INTERVAL 7 DAY AND acquired_ts + INTERVAL 7 DAY),
z AS (SELECT *, first_value(close) OVER (PARTITION BY key ORDER BY CASE WHEN ts <= acquired_ts THEN ts END DESC NULLS LAST) AS p0 FROM p)
SELECT key, acquired_ts, ts, {r6('close', 'close')}, CASE WHEN ts < acquired_ts THEN 'before' WHEN ts > acquired_ts THEN 'after' ELSE 'at' END AS side, {r6('CASE WHEN ts >= acquired_ts THEN (close - p0) / nullif(close, 0) ELSE (p0 - close) / nullif(p0, 0) END', 'change')} FROM z""")
def around_acquisition(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir)
    acquired = b.select("key").distinct().withColumn("acquired_ts", F.lit("2024-01-15 12:00:00").cast("timestamp"))
    return rounded(L.around_acquisition(b, acquired, price="close"))


@query(f"""WITH {USER_TICKS}, a AS (SELECT key, min(ts) AS acquired_ts, first(price ORDER BY ts, event_id) AS acquired_price FROM ticks GROUP BY key), p AS (SELECT a.key, acquired_ts, acquired_price, max(price) AS max_price FROM a JOIN ticks t ON t.key = a.key AND t.ts BETWEEN acquired_ts AND acquired_ts + INTERVAL 7 DAY WHERE price IS NOT NULL GROUP BY ALL)
SELECT key, acquired_ts, {r6('acquired_price', 'acquired_price')}, {r6('max_price', 'max_price')}, {r6('(max_price - acquired_price) / nullif(acquired_price, 0)', 'gain')}, CASE WHEN (max_price - acquired_price) / nullif(acquired_price, 0) >= 0.25 THEN 1 ELSE 0 END AS label_peak FROM p""")
def acquisition_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = user_ticks(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    acquired = t.groupBy("key").agg(F.min("ts").alias("acquired_ts"), F.min_by("price", F.struct("ts", "event_id")).alias("acquired_price"))
    return rounded(L.acquisition_peaks(t, acquired))


# Averages and crosses.
EMA = "RECURSIVE " + GRID + f""",
n AS (SELECT key, ts, price, volume, row_number() OVER {O} AS i FROM grid),
em AS (SELECT key, ts, i, price, volume, price AS n21, 1.0::DOUBLE AS d21, price AS n50, 1.0::DOUBLE AS d50 FROM n WHERE i = 1
  UNION ALL SELECT n.key, n.ts, n.i, n.price, n.volume, em.n21 * (1 - 2 / 22.0::DOUBLE) + n.price, em.d21 * (1 - 2 / 22.0::DOUBLE) + 1, em.n50 * (1 - 2 / 51.0::DOUBLE) + n.price, em.d50 * (1 - 2 / 51.0::DOUBLE) + 1 FROM em JOIN n ON n.key = em.key AND n.i = em.i + 1),
e AS (SELECT key, ts, i, price, volume, n21 / d21 AS ema_21, n50 / d50 AS ema_50 FROM em)"""


def averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.ema(grid(spark, sf_dir), (21, 50))


@query(f"WITH {EMA} SELECT key, ts, {r6('ema_21', 'ema_21')}, {r6('ema_50', 'ema_50')} FROM e")
def exponential_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(averages(spark, sf_dir), "ema_21", "ema_50")


@query(f"""WITH RECURSIVE {GRID}, n AS (SELECT key, ts, price, row_number() OVER {O} AS i, avg(price) OVER w21 AS s FROM grid WINDOW {w('w21', 21)}),
em AS (SELECT key, ts, i, CASE WHEN i = 21 THEN s END AS v FROM n WHERE i <= 21 UNION ALL SELECT n.key, n.ts, n.i, em.v + (n.price - em.v) * 2 / 22.0::DOUBLE FROM em JOIN n ON n.key = em.key AND n.i = em.i + 1 WHERE em.i >= 21) SELECT key, ts, {r6('v', 'ema_21')} FROM em""")
def sma_seeded_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(E.ema(grid(spark, sf_dir), 21, seed="sma"), "ema_21")


_FLAGS = EMA + ", f AS (SELECT *, CASE WHEN ema_21 - ema_50 > 1e-12 * abs(ema_50) THEN 1 ELSE 0 END AS above, CASE WHEN ema_21 - ema_50 < -1e-12 * abs(ema_50) THEN 1 ELSE 0 END AS below FROM e)"


@query(f"WITH {_FLAGS} SELECT key, ts, above, below, {r6('ema_21 - ema_50', 'ema_gap')}, {', '.join(f'max(above) OVER h{n} AS above_any_{n}, min(above) OVER h{n} AS above_all_{n}, ' + r6(f'avg(above) OVER h{n}', f'above_share_{n}') for n in (6, 24, 30))} FROM f WINDOW {', '.join(f'h{n} AS (PARTITION BY key ORDER BY ts RANGE BETWEEN INTERVAL {n} HOUR PRECEDING AND CURRENT ROW)' for n in (6, 24, 30))}")
def cross_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(E.cross_flags(averages(spark, sf_dir), hours=(6, 24, 30)), "above", "below", "ema_gap", *[f"above_{k}_{n}" for n in (6, 24, 30) for k in ("any", "all", "share")])


CROSSES = EMA + f""",
cl AS (SELECT *, CASE WHEN i > 50 AND lag(ema_21) OVER {O} <= lag(ema_50) OVER {O} AND ema_21 > ema_50 THEN 1 ELSE 0 END AS entry, CASE WHEN i > 50 AND lag(ema_21) OVER {O} >= lag(ema_50) OVER {O} AND ema_21 < ema_50 THEN 1 ELSE 0 END AS close_signal FROM e)"""


def crosses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.cross_labels(averages(spark, sf_dir))


@query(f"WITH {CROSSES} SELECT key, ts, entry, close_signal FROM cl")
def cross_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(crosses(spark, sf_dir), "entry", "close_signal")


@query(f"""WITH {CROSSES}, tg AS (SELECT *, max(CASE WHEN close_signal = 1 THEN ts END) OVER {PAST} AS closed, min(CASE WHEN close_signal = 1 THEN ts END) OVER (PARTITION BY key ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_close_ts FROM cl),
en AS (SELECT key, ts AS entry_ts, price AS entry_price, next_close_ts, least(next_close_ts, ts + INTERVAL 48 HOUR) AS boundary_ts FROM tg WHERE entry = 1 QUALIFY row_number() OVER (PARTITION BY key, closed ORDER BY ts) = 1),
hi AS (SELECT en.*, (SELECT min(x.ts) FROM cl x WHERE x.key = en.key AND x.ts BETWEEN entry_ts AND boundary_ts AND x.price >= entry_price * 1.5) AS gain_ts, (SELECT min(x.ts) FROM cl x WHERE x.key = en.key AND x.ts BETWEEN entry_ts AND boundary_ts AND x.price <= entry_price * 0.5) AS loss_ts FROM en)
SELECT key, entry_ts, {r6('entry_price', 'entry_price')}, next_close_ts, boundary_ts, gain_ts, loss_ts, CASE WHEN gain_ts IS NOT NULL AND (loss_ts IS NULL OR gain_ts <= loss_ts) THEN 1 ELSE 0 END AS label FROM hi""")
def target_before_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(L.target_before_close(crosses(spark, sf_dir), 0.5, 0.5, 48))


def ema_sql(n: int) -> str:
    """Exponential average of close over row numbers i: weights that grow by 1 / r a row, which doubles hold for the lengths of these tables."""
    grow = f"pow({1 / (1 - 2 / (n + 1))!r}, i)"
    return f"sum(close * {grow}) OVER {O} / sum({grow}) OVER {O}"


_EVENT_BARS = HOURLY + f""",
x AS (SELECT *, {ema_sql(21)} AS ema_21, {ema_sql(50)} AS ema_50, greatest(high - low, abs(high - coalesce(lag(close) OVER {O}, close)), abs(low - coalesce(lag(close) OVER {O}, close))) AS tr FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts) AS i FROM bars))"""
_EVENT = {
    "ema_spread": "(ema_21 - ema_50) / nullif(ema_50, 0)", "ema_spread_slope": f"((ema_21 - ema_50) - lag(ema_21 - ema_50, 6) OVER {O}) / nullif(6 * ema_50, 0)", "ema_distance": "(close - ema_50) / nullif(ema_50, 0)", "atr_share": "avg(tr) OVER w14 / nullif(close, 0)",
    "band_width": "4 * stddev_samp(close) OVER w20 / nullif(avg(close) OVER w20, 0)", "place_24": "(close - min(low) OVER w25) / nullif(max(high) OVER w25 - min(low) OVER w25, 0)", "choppiness_24": "ln(nullif(sum(tr) OVER w25 / nullif(max(high) OVER w25 - min(low) OVER w25, 0), 0)) * 100 / ln(24)",
    "volume_ratio_14": "volume / nullif(avg(volume) OVER w14, 0)", "body_ratio": "abs(close - open) / nullif(high - low, 0)",
}


def ema_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.ema(hourly(spark, sf_dir), (21, 50, 200), of="close")


@query(f"WITH {_EVENT_BARS} SELECT key, ts, {', '.join(r6(v, k) for k, v in _EVENT.items())} FROM x WINDOW {w('w14', 14)}, {w('w20', 20)}, {w('w25', 25)}")
def event_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(E.event_features(ema_bars(spark, sf_dir)), *_EVENT)


@query(f"""WITH {HOURLY}, ev AS (SELECT key, ts, close FROM bars WHERE hour(ts) = 10), lv AS (SELECT key, date_trunc('day', ts) AS known_ts, max(high) AS level FROM bars GROUP BY key, date_trunc('day', ts)),
n AS (SELECT ev.key, ev.ts, min(CASE WHEN level >= close THEN level END) AS up, max(CASE WHEN level <= close THEN level END) AS dn FROM ev LEFT JOIN lv ON lv.key = ev.key AND CAST(known_ts AS DATE) <= CAST(ev.ts AS DATE) GROUP BY ev.key, ev.ts)
SELECT ev.key, ev.ts, {r6('(up - close) / nullif(close, 0)', 'resistance_distance')}, {r6('(close - dn) / nullif(close, 0)', 'support_distance')} FROM ev JOIN n USING (key, ts)""")
def nearest_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir)
    levels = b.groupBy("key", F.date_trunc("day", "ts").alias("known_ts")).agg(F.max("high").alias("level"))
    return out(E.nearest_levels(b.where(F.hour("ts") == 10).select("key", "ts", "close"), levels), "resistance_distance", "support_distance")


@query(f"""WITH {HOURLY}, x AS (SELECT key, ts, CASE WHEN hour(ts) % 4 = 0 THEN NULL WHEN key = 'view' THEN NULL ELSE close END AS v FROM bars), o AS (SELECT key, median(v) AS m FROM x GROUP BY key), a AS (SELECT median(v) AS m FROM x)
SELECT x.key, x.ts, {r6('coalesce(v, o.m, a.m, 0)', 'v')} FROM x JOIN o USING (key) CROSS JOIN a""")
def imputed_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = hourly(spark, sf_dir).withColumn("v", F.when((F.hour("ts") % 4 != 0) & (F.col("key") != "view"), F.col("close")))
    return out(E.impute_medians(x.select("key", "ts", "v"), ["v"], exact=True), "v")


_TF = {
    "ema_gap_share": "(ema_21 - ema_50) / nullif(close, 0)", "ema_50_slope_5": f"ema_50 - lag(ema_50, 5) OVER {O}", "atr_14": "avg(str) OVER w14", "ret_week": "close / nullif(first_value(close) OVER w40, 0) - 1", "ret_month": "close / nullif(first_value(close) OVER w120, 0) - 1",
    "volume_spike_week": "volume / nullif(avg(volume) OVER w40, 0)", "volume_spike_month": "volume / nullif(avg(volume) OVER w120, 0)",
}


@query(f"""WITH {HOURLY}, x AS (SELECT *, {ema_sql(21)} AS ema_21, {ema_sql(50)} AS ema_50, {ema_sql(200)} AS ema_200, CASE WHEN lag(close) OVER {O} IS NOT NULL THEN greatest(high - low, abs(high - lag(close) OVER {O}), abs(low - lag(close) OVER {O})) END AS str FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts) AS i FROM bars))
SELECT key, ts, {', '.join(r6(v, k) for k, v in _TF.items())}, ema_21 > ema_50 AND ema_50 > ema_200 AS is_uptrend, coalesce(close > max(high) OVER p20, false) AS breaks_20, coalesce(close > max(high) OVER p50, false) AS breaks_50
FROM x WINDOW {w('w14', 14)}, {w('w40', 40)}, {w('w120', 120)}, p20 AS (PARTITION BY key ORDER BY ts ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), p50 AS (PARTITION BY key ORDER BY ts ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)""")
def strong_trend_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(E.trend_features(ema_bars(spark, sf_dir), 40, 120), *_TF, "is_uptrend", "breaks_20", "breaks_50")


_REGIME = DAILY + f""",
x AS (SELECT *, {ema_sql(21)} AS ema_21, {ema_sql(50)} AS ema_50, {ema_sql(200)} AS ema_200, CASE WHEN lag(close) OVER {O} IS NOT NULL THEN greatest(high - low, abs(high - lag(close) OVER {O}), abs(low - lag(close) OVER {O})) END AS str FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts) AS i FROM daily)),
y AS (SELECT *, ema_21 > ema_50 AND ema_50 > ema_200 AS up, avg(str) OVER w14 / nullif(close, 0) AS atr_share, close / nullif(first_value(close) OVER w30, 0) - 1 AS ret_month, volume / nullif(avg(volume) OVER w7, 0) AS spike, lag(ema_21) OVER {O} AS f0, lag(ema_50) OVER {O} AS s0 FROM x WINDOW {w('w7', 7)}, {w('w14', 14)}, {w('w30', 30)}),
z AS (SELECT *, coalesce(up AND atr_share BETWEEN 0.01 AND 0.6 AND ret_month > -0.3 AND spike BETWEEN 0.2 AND 5, false) AS in_regime FROM y),
sg AS (SELECT *, CASE WHEN coalesce(ema_21 > ema_50 AND f0 <= s0, false) AND in_regime THEN 1 ELSE 0 END AS entry, CASE WHEN coalesce(ema_21 < ema_50 AND f0 >= s0, false) OR coalesce(NOT up, false) OR coalesce(atr_share > 0.9, false) THEN 1 ELSE 0 END AS close_signal FROM z)"""


def regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = E.ema(daily(spark, sf_dir), (21, 50, 200), of="close")
    return T.trend_regime(E.trend_features(d, 7, 30), atr_share=(0.01, 0.6), least_month=-0.3, volume=(0.2, 5.0), most_atr=0.9)


@query(f"WITH {_REGIME} SELECT key, ts, {r6('atr_share', 'atr_share')}, in_regime, entry, close_signal FROM sg")
def trend_regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(regime(spark, sf_dir), "atr_share", "in_regime", "entry", "close_signal")


@query(f"""WITH {_REGIME}, t AS (SELECT e.*, (SELECT min(n.ts) FROM sg n WHERE n.key = e.key AND n.ts > e.ts AND n.close_signal = 1) AS close_ts FROM sg e WHERE entry = 1),
g AS (SELECT t.key, t.ts AS entry_ts, t.close AS entry_price, close_ts, t.ret_month, t.in_regime, count(*) - 1 AS bars, max(x.close) AS hi, min(x.close) AS lo, max(x.atr_share) AS max_atr_share, avg(x.atr_share) AS mean_atr_share, max(CASE WHEN x.ts = close_ts THEN x.close END) AS exit_price FROM t JOIN sg x ON x.key = t.key AND x.ts BETWEEN t.ts AND close_ts GROUP BY ALL)
SELECT key, entry_ts, {r6('entry_price', 'entry_price')}, close_ts, {r6('exit_price', 'exit_price')}, bars, {r6('exit_price / nullif(entry_price, 0) - 1', 'realized')}, {r6('hi / nullif(entry_price, 0) - 1', 'runup')}, {r6('exit_price / nullif(hi, 0) - 1', 'pullback')}, {r6('lo / nullif(entry_price, 0) - 1', 'drawdown')}, {r6('ret_month', 'ret_month')}, in_regime, {r6('max_atr_share', 'max_atr_share')}, {r6('mean_atr_share', 'mean_atr_share')} FROM g""")
def regime_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.trades_to_close(regime(spark, sf_dir), price="close", at_entry=["ret_month", "in_regime"], largest=["atr_share"], mean=["atr_share"]))


# Trades.
BANDS = DAILY + f""",
b1 AS (SELECT *, avg(close) OVER w20 AS sma_20, stddev_samp(close) OVER w20 AS std_20, avg(close) OVER w50 AS trend, avg(volume) OVER w20 AS vs, CASE WHEN close > lag(close) OVER {O} THEN close - lag(close) OVER {O} ELSE 0 END AS g, CASE WHEN close < lag(close) OVER {O} THEN lag(close) OVER {O} - close ELSE 0 END AS l FROM (SELECT key, ts, 100 * ln(close) AS close, volume FROM daily) WINDOW {w('w20', 20)}, {w('w50', 50)}),
b2 AS (SELECT *, CASE WHEN avg(l) OVER w14 = 0 THEN 100 ELSE 100 - 100 / (1 + avg(g) OVER w14 / avg(l) OVER w14) END AS rsi_14, lag(trend, 24) OVER {O} AS trend_before, sma_20 + 2 * std_20 AS band_high, sma_20 - 2 * std_20 AS band_low, CASE WHEN vs > 0 THEN volume / vs ELSE 0 END AS volume_ratio, CASE WHEN close > 0 THEN (sma_20 - close) / close ELSE 0 END AS reward FROM b1 WINDOW {w('w14', 14)})"""


def bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On log prices, as prices are so skewed that none lies below its band; the variant without a price over its trend, which no bar below its band has."""
    logged = daily(spark, sf_dir).withColumn("close", 100 * F.ln("close"))
    return T.bollinger_indicators(logged, trend=50, least_volume=0.2, most_rsi=60.0, variant="uptrend")


@query(f"""WITH {BANDS} SELECT key, ts, {', '.join(r6(c, c) for c in ('sma_20', 'std_20', 'rsi_14', 'band_high', 'band_low', 'volume_ratio', 'reward'))}, trend > trend_before AND close < band_low AND volume_ratio > 0.2 AND rsi_14 < 60 AS signal_entry, close >= sma_20 AS signal_exit FROM b2""")
def bollinger_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(bands(spark, sf_dir), "sma_20", "std_20", "rsi_14", "band_high", "band_low", "volume_ratio", "reward", "signal_entry", "signal_exit")


TRADES = HOURLY + f""",
sg AS (SELECT *, avg(close) OVER w20 AS sma FROM bars WINDOW {w('w20', 20)}),
en AS (SELECT key, ts AS entry_ts, close AS entry_price FROM sg WHERE close < 0.3 * sma),
ev AS (SELECT en.*, s.ts, s.close, CASE WHEN (s.close - entry_price) / nullif(entry_price, 0) <= -0.05 THEN 'stop' WHEN s.close >= s.sma THEN 'signal' END AS reason FROM en JOIN sg s ON s.key = en.key AND s.ts > entry_ts AND s.ts < entry_ts + INTERVAL 7 DAY),
cl AS (SELECT *, row_number() OVER (PARTITION BY key, entry_ts ORDER BY ts) AS n FROM ev WHERE reason IS NOT NULL),
tr AS (SELECT c.key, c.entry_ts, c.entry_price, c.ts AS exit_ts, c.close AS exit_price, c.reason, (SELECT min(low) FROM bars b WHERE b.key = c.key AND b.ts BETWEEN c.entry_ts AND c.ts) AS worst_low FROM cl c WHERE n = 1)"""


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir).withColumn("sma", F.avg("close").over(R.S.rows(20)))
    return T.extract_trades(b, F.col("close") < 0.3 * F.col("sma"), F.col("close") >= F.col("sma"))


@query(f"""WITH {TRADES} SELECT key, entry_ts, {r6('entry_price', 'entry_price')}, exit_ts, {r6('exit_price', 'exit_price')}, reason, {r6('(exit_price - entry_price) / nullif(entry_price, 0)', 'realized')}, {r6('(worst_low - entry_price) / nullif(entry_price, 0)', 'drawdown')},
CAST(floor((epoch(exit_ts) - epoch(entry_ts)) / 3600) AS BIGINT) AS hours, md5(key || '-' || CAST(CAST(epoch(entry_ts) AS BIGINT) AS VARCHAR)) AS trade_id FROM tr""")
def extracted_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trades(spark, sf_dir).drop("worst_low"))


@query(f"""WITH {CROSSES}, t AS (SELECT en.key, en.ts AS entry_ts, en.price AS entry_price, (SELECT min(x.ts) FROM cl x WHERE x.key = en.key AND x.ts > en.ts AND x.close_signal = 1) AS close_ts FROM cl en WHERE en.entry = 1),
s AS (SELECT t.*, c.price AS exit_price, (SELECT max(price) FROM cl x WHERE x.key = t.key AND x.ts BETWEEN entry_ts AND close_ts) AS hi, (SELECT min(price) FROM cl x WHERE x.key = t.key AND x.ts BETWEEN entry_ts AND close_ts) AS lo, (SELECT count(*) FROM cl x WHERE x.key = t.key AND x.ts > entry_ts AND x.ts <= close_ts) AS bars
  FROM t JOIN cl c ON c.key = t.key AND c.ts = t.close_ts)
SELECT key, entry_ts, {r6('entry_price', 'entry_price')}, close_ts, {r6('exit_price', 'exit_price')}, bars, {r6('(exit_price - entry_price) / nullif(entry_price, 0)', 'realized')}, {r6('(hi - entry_price) / nullif(entry_price, 0)', 'runup')}, {r6('(exit_price - hi) / nullif(hi, 0)', 'pullback')}, {r6('(lo - entry_price) / nullif(entry_price, 0)', 'drawdown')} FROM s""")
def trades_to_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.trades_to_close(crosses(spark, sf_dir)))


@query(f"""WITH {CROSSES}, o AS (SELECT *, CAST(sum(entry) OVER {PAST} AS BIGINT) AS trade_id FROM cl), b AS (SELECT *, min(CASE WHEN close_signal = 1 THEN i END) OVER t AS ci, max(CASE WHEN entry = 1 THEN price END) OVER t AS ep, max(i) OVER t AS li FROM o WINDOW t AS (PARTITION BY key, trade_id))
SELECT key, ts, trade_id, {r6('CASE WHEN trade_id > 0 THEN (max(CASE WHEN i <= coalesce(ci, li) THEN price END) OVER (PARTITION BY key, trade_id) - ep) / nullif(ep, 0) * 100 END', 'max_gain')} FROM b""")
def gains_until_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(T.gain_until_close(crosses(spark, sf_dir), price="price", high="price"), "trade_id", "max_gain")


_COMBO = TRADES + """,
al AS (SELECT key, entry_ts, (exit_price - entry_price) / nullif(entry_price, 0) AS realized, 0 AS s FROM tr WHERE key IN ('view', 'click') UNION ALL SELECT key, entry_ts, (exit_price - entry_price) / nullif(entry_price, 0), 1 FROM tr WHERE key NOT IN ('click')),
tk AS (SELECT * FROM al QUALIFY row_number() OVER (PARTITION BY entry_ts ORDER BY s, key) <= 1),
mo AS (SELECT CAST(date_trunc('month', entry_ts) AS DATE) AS month, count(CASE WHEN s = 0 THEN 1 END) AS first_trades, avg(CASE WHEN s = 0 THEN realized END) AS first_mean, count(CASE WHEN s = 1 THEN 1 END) AS second_trades, avg(CASE WHEN s = 1 THEN realized END) AS second_mean, count(*) AS trades, sum(realized) AS total FROM tk GROUP BY 1)"""


@query(f"WITH {_COMBO} SELECT month, first_trades, {r6('first_mean', 'first_mean')}, second_trades, {r6('second_mean', 'second_mean')}, trades, {r6('total', 'total')}, {r6('sum(total) OVER (ORDER BY month)', 'equity')} FROM mo")
def combined_strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trades(spark, sf_dir)
    return rounded(T.combine_strategies({"first": t.where(F.col("key").isin("view", "click")), "second": t.where("key <> 'click'")}, most=1))


_PRIOR = TRADES + """,
rz AS (SELECT key, entry_ts, exit_ts, (exit_price - entry_price) / nullif(entry_price, 0) AS realized FROM tr),
pr AS (SELECT a.key, a.entry_ts, (epoch(a.entry_ts) - epoch(b.entry_ts)) / 3600 AS ago, b.exit_ts <= a.entry_ts AS done, b.realized FROM rz a JOIN rz b ON b.key = a.key AND b.entry_ts < a.entry_ts AND b.entry_ts >= a.entry_ts - INTERVAL 168 HOUR),
pf AS (SELECT key, entry_ts, """ + ", ".join(f"count(CASE WHEN ago <= {h} AND done AND realized > 0 THEN 1 END) AS wins_{h}, count(CASE WHEN ago <= {h} AND done AND realized <= 0 THEN 1 END) AS losses_{h}, count(CASE WHEN ago <= {h} AND NOT done THEN 1 END) AS open_{h}" for h in (12, 168)) + """,
  min(ago) AS hours_since, sum(CASE WHEN done AND realized > 0 THEN exp(-ln(2) * ago / 24) ELSE 0 END) AS decayed_wins FROM pr GROUP BY key, entry_ts)"""


@query(f"WITH {_PRIOR} SELECT rz.key, rz.entry_ts, {', '.join(f'coalesce({k}_{h}, 0) AS {k}_{h}' for h in (12, 168) for k in ('wins', 'losses', 'open'))}, {r6('hours_since', 'hours_since')}, {r6('coalesce(decayed_wins, 0)', 'decayed_wins')}, {r6('coalesce(wins_168, 0) / nullif(coalesce(wins_168, 0) + coalesce(losses_168, 0), 0)::DOUBLE', 'win_rate_168')} FROM rz LEFT JOIN pf USING (key, entry_ts)")
def prior_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = T.prior_trade_features(trades(spark, sf_dir).select("key", "entry_ts", "exit_ts", "realized"), hours=(12, 168))
    return rounded(found.select("key", "entry_ts", *[f"{k}_{h}" for h in (12, 168) for k in ("wins", "losses", "open")], "hours_since", "decayed_wins", "win_rate_168"))


# Decision log.
LOG = "lg AS (SELECT user_id % 3 AS model_id, event_type AS token, ts, value > 250 AS admitted, CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS fill_side, value AS fill_size_usd, 30.0 AS fill_fee_bps, event_id FROM events)"


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select((F.col("user_id") % 3).alias("model_id"), F.col("event_type").alias("token"), "ts", (F.col("value") > 250).alias("admitted"), F.when(F.col("event_id") % 2 == 0, "buy").otherwise("sell").alias("fill_side"), F.col("value").alias("fill_size_usd"), F.lit(30.0).alias("fill_fee_bps"), "event_id")


@query(f"WITH {LOG} SELECT event_id, model_id, token, ts, CASE WHEN fill_side = 'buy' THEN 1 ELSE -1 END AS side, {r6('CASE WHEN fill_side = $$buy$$ THEN 1 ELSE -1 END * fill_size_usd', 'signed_usd')}, {r6('fill_size_usd * fill_fee_bps / 10000', 'fee_usd')} FROM lg WHERE admitted")
def fills_blotter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.fills_blotter(decisions(spark, sf_dir)).select("event_id", "model_id", "token", "ts", "side", "signed_usd", "fee_usd"))


@query(f"""WITH {LOG} SELECT model_id, date_trunc('day', ts) AS cycle, count(*) AS decisions, count(CASE WHEN admitted THEN 1 END) AS admitted, count(CASE WHEN admitted AND fill_side = 'buy' THEN 1 END) AS buys, count(CASE WHEN admitted AND fill_side = 'sell' THEN 1 END) AS sells,
count(DISTINCT token) AS tokens, count(DISTINCT CASE WHEN admitted THEN token END) AS traded_tokens FROM lg GROUP BY model_id, date_trunc('day', ts)""")
def activity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.activity_report(decisions(spark, sf_dir))


@query(f"""WITH {LOG}, d AS (SELECT model_id, date_trunc('day', ts) AS cycle, -sum(CASE WHEN fill_side = 'buy' THEN fill_size_usd ELSE -fill_size_usd END) - sum(fill_size_usd * fill_fee_bps / 10000) AS flow, count(*) AS fills FROM lg WHERE admitted GROUP BY model_id, date_trunc('day', ts))
SELECT model_id, cycle, {r6('flow', 'flow')}, fills, {r6('sum(flow) OVER (PARTITION BY model_id ORDER BY cycle)', 'cash')} FROM d""")
def ledger_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(T.ledger_curve(decisions(spark, sf_dir)))


# Levels and patterns.
ATR = DAILY + f""",
a1 AS (SELECT *, greatest(high - low, abs(high - coalesce(lag(close) OVER {O}, close)), abs(low - coalesce(lag(close) OVER {O}, close))) AS tr FROM daily), a2 AS (SELECT *, avg(tr) OVER w14 AS atr FROM a1 WINDOW {w('w14', 14)})"""
SWING = ATR + """,
sw AS (SELECT *, high = max(high) OVER c AND high - min(low) OVER c >= 0.5 * atr AS top, low = min(low) OVER c AND max(high) OVER c - low >= 0.5 * atr AS bottom FROM a2 WINDOW c AS (PARTITION BY key ORDER BY ts ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)),
sp AS (SELECT key, ts, high AS level, volume FROM sw WHERE top UNION ALL SELECT key, ts, low, volume FROM sw WHERE bottom)"""
BINS = SWING + """,
wd AS (SELECT key, median(CASE WHEN CAST(ts AS DATE) >= DATE '2001-11-04' - 400 THEN atr END) AS ma, arg_max(close, ts) AS lc FROM a2 GROUP BY key), ws AS (SELECT key, greatest(0.75 * ma, 0.01 * lc, 1e-9) AS bs FROM wd WHERE ma IS NOT NULL),
bi AS (SELECT key, round(level / bs) * bs AS level, bs AS bin_size, count(*) AS touches, sum((1 + log10(greatest(volume, 1.0))) * power(0.5, date_diff('day', CAST(ts AS DATE), DATE '2001-11-04') / 90.0)) AS score, min(ts) AS first_touch, max(ts) AS last_touch FROM sp JOIN ws USING (key) GROUP BY key, round(level / bs) * bs, bs HAVING count(*) >= 2)"""


def level_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.level_bins(daily(spark, sf_dir), F.lit("2001-11-04").cast("timestamp"), lookback_days=400)


@query(f"WITH {ATR} SELECT key, ts, {r6('atr', 'atr_14')} FROM a2")
def average_true_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(V.average_true_range(daily(spark, sf_dir)), "atr_14")


@query(f"WITH {SWING} SELECT key, ts, {r6('level', 'level')}, {r6('volume', 'volume')} FROM sp")
def swing_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(V.swing_points(V.average_true_range(daily(spark, sf_dir))), "level", "volume")


@query(f"WITH {BINS} SELECT key, {r6('level', 'level')}, touches, {r6('score', 'score')}, first_touch, last_touch FROM bi")
def scored_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(level_bins(spark, sf_dir).select("key", "level", "touches", "score", "first_touch", "last_touch"))


@query(f"""WITH {BINS}, st AS (SELECT key, round((max(level) - min(level)) / nullif(max(bin_size), 0)) AS slots, stddev_samp(score) / nullif(avg(score), 0) AS cv, count(*) AS n, list_sort(list(score)) AS a FROM bi GROUP BY key),
ct AS (SELECT key, a[CAST(round(greatest(0.5, least(0.8, 0.6 + 0.15 * coalesce(least(2.0, cv), 0) + 0.1 * coalesce(least(2.0, n / nullif(nullif(slots, 1), 0)), 0))) * (n - 1)) AS INT) + 1] AS cut FROM st)
SELECT bi.key, {r6('level', 'level')}, touches, {r6('score', 'score')} FROM bi JOIN ct USING (key) WHERE score >= cut""")
def strongest_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(V.strongest_levels(level_bins(spark, sf_dir)).select("key", "level", "touches", "score"))


PATTERN = SHAPED + f""",
p1 AS (SELECT *, high - low AS span, abs(close - open) AS body, close >= open AS green, (close - lag(close) OVER {O}) / nullif(lag(close) OVER {O}, 0) AS move FROM bars),
p2 AS (SELECT *, body / nullif(span, 0) AS bs, CASE WHEN lag(green) OVER {O} IS NOT NULL THEN CASE WHEN green <> lag(green) OVER {O} THEN 1.0 ELSE 0.0 END END AS turn FROM p1),
p3 AS (SELECT key, count(*) AS n, quantile_cont(close, 0.5) AS median_close, stddev_samp(close) AS std_close, min(close) AS min_close, max(close) AS max_close, quantile_cont(close, 0.01) AS p01_close, quantile_cont(close, 0.99) AS p99_close, quantile_cont(low, 0.01) AS p01_low, max(volume) AS max_volume, quantile_cont(volume, 0.5) AS median_volume,
  avg(CASE WHEN volume IS NULL OR volume = 0 THEN 1.0 ELSE 0.0 END) AS zero_volume_share, avg(span) AS mean_span, avg(bs) AS mean_body_share, quantile_cont(bs, 0.5) AS median_body_share, avg(CASE WHEN span > 0 AND bs <= 0.15 THEN 1.0 ELSE 0.0 END) AS wick_share, quantile_cont(span, 0.05) AS p05_span, quantile_cont(span, 0.95) AS p95_span,
  avg(CASE WHEN green THEN 1.0 ELSE 0.0 END) AS green_share, avg(CASE WHEN move IS NULL OR abs(move) < 0.002 THEN 1.0 ELSE 0.0 END) AS tiny_move_share, avg(CASE WHEN abs(move) > 0.3 THEN 1.0 ELSE 0.0 END) AS big_move_share, avg(turn) AS turn_share FROM p2 GROUP BY key HAVING count(*) >= 100),
p4 AS (SELECT *, std_close / nullif(median_close, 0) AS close_vol_ratio, mean_span / nullif(median_close, 0) AS span_ratio, p01_low / nullif(median_close, 0) AS p01_low_ratio, max_close / nullif(min_close, 0) AS max_to_min, p01_close / nullif(max_close, 0) AS p01_to_max, p01_close / nullif(p99_close, 0) AS p01_to_p99, max_volume / nullif(median_volume, 0) AS volume_peak_ratio, p95_span / nullif(p05_span, 0) AS span_spread FROM p3)"""
_PF = ["median_close", "std_close", "p01_close", "p99_close", "zero_volume_share", "mean_span", "mean_body_share", "wick_share", "green_share", "tiny_move_share", "big_move_share", "turn_share", "close_vol_ratio", "span_ratio", "max_to_min", "volume_peak_ratio", "span_spread"]


@query(f"WITH {PATTERN} SELECT key, n, {', '.join(r6(c, c) for c in _PF)} FROM p4")
def distribution_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(P.distribution_features(shaped(spark, sf_dir), least_rows=100).select("key", "n", *_PF))


_MERGED = {"median_close": "quantile_disc(close, 0.5)", "p01_close": "quantile_disc(close, 0.01)", "p99_close": "quantile_disc(close, 0.99)", "median_volume": "quantile_disc(volume, 0.5)", "p95_span": "quantile_disc(span, 0.95)"}


@query(f"""WITH {PATTERN.replace('FROM bars)', "FROM (SELECT * FROM bars WHERE ts >= TIMESTAMP '1993-01-01' AND ts < TIMESTAMP '1996-07-01'))", 1)}
SELECT key, n, {', '.join(r6(c, c) for c in ('std_close', 'max_to_min', 'mean_span', 'green_share', 'tiny_move_share', 'turn_share', 'zero_volume_share'))}, {', '.join(r6(f'(SELECT {x} FROM p2 WHERE p2.key = p3.key)', c) for c, x in _MERGED.items())} FROM (SELECT *, max_close / nullif(min_close, 0) AS max_to_min FROM p3) p3""")
def merged_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of some years from monthly states with quantile sketches, which are exact for so few rows of a key."""
    states = K.period_states(shaped(spark, sf_dir), "month")
    found = K.distribution_of(states, since=F.lit("1993-01-01").cast("timestamp"), until=F.lit("1996-07-01").cast("timestamp"), least_rows=100)
    return rounded(found.select("key", "n", "std_close", "max_to_min", "mean_span", "green_share", "tiny_move_share", "turn_share", "zero_volume_share", *_MERGED))


# The patterns' conditions, stated here for themselves.
_TESTS = {
    "decay": "max_to_min >= 10 AND green_share <= 0.35 AND p01_close / nullif(max_close, 0) <= 0.15",
    "flash": "p01_low / nullif(median_close, 0) <= 0.10 AND p01_close / nullif(p99_close, 0) >= 0.40",
    "frozen": "close_vol_ratio <= 0.02 AND tiny_move_share >= 0.70",
    "micro": "turn_share >= 0.60 AND median_body_share <= 0.10 AND p95_span / nullif(p05_span, 0) <= 5 AND close_vol_ratio BETWEEN 0.01 AND 0.20",
    "park": "max_to_min >= 8 AND close_vol_ratio <= 0.05 AND green_share >= 0.60",
    "pump": "max_to_min >= 15 AND big_move_share >= 0.02 AND p01_close / nullif(max_close, 0) <= 0.20",
    "side": "(green_share >= 0.85 OR green_share <= 0.15) AND max_to_min >= 5",
    "stable": "close_vol_ratio <= 0.01 AND max_to_min <= 1.05",
    "thin": "span_ratio >= 0.30 AND zero_volume_share >= 0.40",
    "wash": "close_vol_ratio <= 0.03 AND volume_peak_ratio >= 10 AND zero_volume_share <= 0.10",
    "wicks": "wick_share >= 0.70 AND mean_body_share <= 0.20 AND span_ratio >= 0.30",
}


@query(f"WITH {PATTERN} SELECT key, {', '.join(f'coalesce({t}, false) AS {n}' for n, t in _TESTS.items())} FROM p4")
def pattern_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.pattern_flags(P.distribution_features(shaped(spark, sf_dir), least_rows=100)).select("key", *P.PATTERNS)


_DETECT = "dt AS (SELECT l_suppkey AS key, l_returnflag AS pattern, CAST(l_shipdate AS DATE) AS window_start FROM lineitem)"


@query(f"WITH {_DETECT} SELECT key, pattern FROM dt GROUP BY key, pattern HAVING date_diff('day', min(window_start), max(window_start)) > 2450 UNION ALL SELECT s_suppkey, 'manual:' || s_name FROM supplier WHERE s_suppkey < 3")
def hardened_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = load(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("key"), F.col("l_returnflag").alias("pattern"), F.to_date("l_shipdate").alias("window_start"))
    manual = load(spark, sf_dir, "supplier").where("s_suppkey < 3").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("notes"))
    return P.hardened_exclusions(d, manual, 2450)


@query("""SELECT user_id AS key, bool_or(value > 150) AS high, bool_or(value < 1) AS low, max(ts) AS processed_at, arg_max(value > 150, ts) AS latest_high, arg_max(value < 1, ts) AS latest_low FROM events GROUP BY user_id""")
def flag_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select(F.col("user_id").alias("key"), (F.col("value") > 150).alias("high"), (F.col("value") < 1).alias("low"), F.col("ts").alias("processed_at"))
    return P.flag_rollup(e)


_WRAP = GRID + ", wg AS (SELECT key, ts, price FROM grid UNION ALL SELECT 'wrapped ' || key, ts, price * (1 + length(key) / 16.0) FROM grid UNION ALL SELECT 'coin ' || key, ts, 1 + hour(ts) * length(key) * 1e-6 FROM grid)"


def wrapped_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grid(spark, sf_dir).select("key", "ts", "price")
    wrapped = g.select(F.concat(F.lit("wrapped "), "key").alias("key"), "ts", (F.col("price") * (1 + F.length("key") / 16)).alias("price"))
    return g.unionByName(wrapped).unionByName(g.select(F.concat(F.lit("coin "), "key").alias("key"), "ts", (1 + F.hour("ts") * F.length("key") * 1e-6).alias("price")))


@query(f"WITH {_WRAP} SELECT a.key, b.key AS reference, count(*) AS n, {r6('avg(a.price / b.price)', 'mean_ratio')} FROM wg a JOIN wg b ON b.ts = a.ts AND b.key IN ('view', 'click', 'purchase') AND a.key <> b.key WHERE a.price > 0 AND b.price > 0 GROUP BY a.key, b.key HAVING count(*) >= 200 AND stddev_samp(ln(a.price / b.price)) < 0.01 AND avg(a.price / b.price) BETWEEN 0.5 AND 3")
def wrapped_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(P.wrapped_assets(wrapped_grid(spark, sf_dir), ["view", "click", "purchase"]).drop("ratio_std"))


@query(f"WITH {_WRAP}, m AS (SELECT key, ln(price / nullif(lag(price) OVER {O}, 0)) AS r FROM wg WHERE price > 0) SELECT key, count(*) AS n, {r6('stddev_samp(r) * 100', 'vol_pct')} FROM m GROUP BY key HAVING count(*) >= 200 AND stddev_samp(r) * 100 < 0.10")
def pegged_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(P.pegged_assets(wrapped_grid(spark, sf_dir)))


@query(f"WITH {RETURNS} SELECT key, {r6('median(dollar_volume)', 'median_volume')}, {r6('median(price * (length(key) - 3) / 2.0)', 'median_cap')} FROM r GROUP BY key HAVING median(dollar_volume) > 3 * median(price * (length(key) - 3) / 2.0)")
def wash_traded(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = base(spark, sf_dir).withColumn("mktcap", F.col("price") * (F.length("key") - 3) / 2)
    return rounded(P.wash_traded(df))


# Universe.
SCALED = U.Rules(least_bars=30, entry_cap=42.0, exit_cap=38.0, entry_rank=60, exit_rank=90, cap_weeks=2, volume_weeks=2)
WEEKLY = """ub AS (SELECT user_id AS key, ts, value AS mktcap, value * (event_id % 10 + 1) AS dollar_volume, (floor(epoch(ts)) - floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)))) / 3600 AS gap FROM events),
wk AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-03-04', INTERVAL 7 DAY)) AS week),
um AS (SELECT key, CAST(week AS DATE) AS week_start, count(*) AS trailing_bars, median(mktcap) AS median_cap, median(dollar_volume) AS median_volume, max(gap) AS longest_gap_hours FROM ub JOIN wk ON week > ts AND week <= ts + INTERVAL 30 DAY GROUP BY key, week)"""
RANKED = WEEKLY + f""",
ur AS (SELECT *, CASE WHEN trailing_bars >= 30 AND median_volume IS NOT NULL THEN rank() OVER (PARTITION BY week_start ORDER BY CASE WHEN trailing_bars >= 30 THEN median_volume END DESC NULLS LAST, key) END AS volume_rank FROM um),
fi AS (SELECT key, min(week_start) AS fw FROM um GROUP BY key), gr AS (SELECT key, week_start FROM fi CROSS JOIN (SELECT DISTINCT week_start FROM um) WHERE week_start >= fw),
ui AS (SELECT key, week_start, coalesce(trailing_bars, 0) AS trailing_bars, median_cap, median_volume, volume_rank, coalesce(median_cap < {SCALED.exit_cap}, true) AS low_cap, coalesce(volume_rank > {SCALED.exit_rank}, true) AS bad_volume,
  coalesce(trailing_bars >= 30 AND median_cap >= {SCALED.entry_cap} AND volume_rank <= {SCALED.entry_rank}, false) AS meets_entry FROM gr LEFT JOIN ur USING (key, week_start))"""


def universe_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("key"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("mktcap"), (F.col("value") * (F.col("event_id") % 10 + 1)).alias("dollar_volume"))


@query(f"WITH {WEEKLY} SELECT key, week_start, trailing_bars, {r6('median_cap', 'median_cap')}, {r6('median_volume', 'median_volume')}, {r6('longest_gap_hours', 'longest_gap_hours')} FROM um")
def weekly_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(U.weekly_metrics(universe_bars(spark, sf_dir)))


@query(f"WITH {RANKED} SELECT key, week_start, CAST(volume_rank AS INT) AS volume_rank FROM ur")
def weekly_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.weekly_rank(U.weekly_metrics(universe_bars(spark, sf_dir)), SCALED).select("key", "week_start", "volume_rank")


@query(f"WITH {RANKED} SELECT key, week_start, trailing_bars, CAST(volume_rank AS INT) AS volume_rank, low_cap, bad_volume, meets_entry FROM ui")
def weekly_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.weekly_inputs(U.weekly_metrics(universe_bars(spark, sf_dir)), SCALED).select("key", "week_start", "trailing_bars", "volume_rank", "low_cap", "bad_volume", "meets_entry")


STATE = "RECURSIVE " + RANKED + """,
un AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY week_start) AS i FROM ui),
us AS (SELECT key, week_start, i, CAST(CASE WHEN low_cap THEN 1 ELSE 0 END AS BIGINT) AS low_cap_streak, CAST(CASE WHEN bad_volume THEN 1 ELSE 0 END AS BIGINT) AS bad_volume_streak, meets_entry AS member, false AS was FROM un WHERE i = 1
  UNION ALL SELECT n.key, n.week_start, n.i, CASE WHEN n.low_cap THEN s.low_cap_streak + 1 ELSE 0 END, CASE WHEN n.bad_volume THEN s.bad_volume_streak + 1 ELSE 0 END,
  CASE WHEN s.member THEN NOT ((n.low_cap AND s.low_cap_streak + 1 >= 2) OR (n.bad_volume AND s.bad_volume_streak + 1 >= 2)) ELSE n.meets_entry END, s.member FROM us s JOIN un n ON n.key = s.key AND n.i = s.i + 1)"""


def state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.membership_state(U.weekly_inputs(U.weekly_metrics(universe_bars(spark, sf_dir)), SCALED), rules=SCALED)


@query(f"WITH {STATE} SELECT key, week_start, low_cap_streak, bad_volume_streak, member, member AND NOT was AS entered, was AND NOT member AS exited FROM us")
def membership_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state(spark, sf_dir).select("key", "week_start", "low_cap_streak", "bad_volume_streak", "member", "entered", "exited")


@query(f"WITH {STATE} SELECT key, week_start, member, 'v2' AS rule_version FROM us")
def versioned_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return U.membership("v2", universe_bars(spark, sf_dir), rules=SCALED).select("key", "week_start", "member", "rule_version")


@query(f"WITH {WEEKLY}, xc AS (SELECT DISTINCT user_id AS key, CASE WHEN user_id % 2 = 0 THEN NULL ELSE DATE '2024-01-29' END AS f FROM events WHERE user_id % 5 = 0) SELECT um.key, week_start, trailing_bars FROM um LEFT JOIN xc USING (key) WHERE xc.key IS NULL OR (f IS NOT NULL AND week_start < f)")
def dated_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = universe_bars(spark, sf_dir)
    excluded = b.select("key").distinct().where("key % 5 = 0").withColumn("effective_from", F.when(F.col("key") % 2 != 0, F.lit("2024-01-29").cast("date")))
    return U.without_excluded(U.weekly_metrics(b), excluded).select("key", "week_start", "trailing_bars")


# Sampling and scoring.
_UND = "yy AS (SELECT event_id, CASE WHEN value > 100 THEN 1 ELSE 0 END AS y, md5(CAST(event_id AS VARCHAR)) AS h FROM events), kk AS (SELECT floor(least(count(CASE WHEN y = 1 THEN 1 END) / 0.4, count(CASE WHEN y = 0 THEN 1 END) / 0.6) + 1e-9) AS k FROM yy), rk AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY h) AS i FROM yy)"


@query(f"WITH {_UND} SELECT event_id, y FROM rk, kk WHERE i <= CASE WHEN y = 1 THEN floor(k * 0.4 + 1e-9) ELSE floor(k * 0.6 + 1e-9) END")
def undersampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("event_id", F.when(F.col("value") > 100, 1).otherwise(0).alias("y"))
    return A.undersample(e, "y", ["event_id"])


@query(f"""WITH e AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS y, value AS f1, CAST(event_id % 10 + 1 AS DOUBLE) AS f2, CAST(hour(ts) AS DOUBLE) AS f3 FROM events WHERE value IS NOT NULL),
c AS (SELECT y, count(*) AS n, sum(f1) AS s1, sum(f2) AS s2, sum(f3) AS s3 FROM e GROUP BY y),
m AS (SELECT y, ln(n + 1) - ln((SELECT sum(n) FROM c) + 2) AS a0, ln(s1 + 1) - ln(s1 + s2 + s3 + 3) AS a1, ln(s2 + 1) - ln(s1 + s2 + s3 + 3) AS a2, ln(s3 + 1) - ln(s1 + s2 + s3 + 3) AS a3 FROM c),
z AS (SELECT event_id, 1 / (1 + exp((n.a0 + f1 * n.a1 + f2 * n.a2 + f3 * n.a3) - (p.a0 + f1 * p.a1 + f2 * p.a2 + f3 * p.a3))) AS p1 FROM e, m n, m p WHERE n.y = 0 AND p.y = 1)
SELECT event_id, {r6('p1', 'p1')} FROM z WHERE p1 >= 0.33""")
def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A naive Bayes pipeline, fitted and applied: the one Spark ML classifier whose scores SQL can state."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import VectorAssembler

    e = load(spark, sf_dir, "events").where("value IS NOT NULL")
    e = e.select("event_id", F.when(F.col("user_id") % 3 == 0, 1.0).otherwise(0.0).alias("label"), F.col("value").alias("f1"), (F.col("event_id") % 10 + 1).cast("double").alias("f2"), F.hour("ts").cast("double").alias("f3"))
    model = Pipeline(stages=[VectorAssembler(inputCols=["f1", "f2", "f3"], outputCol="features"), NaiveBayes()]).fit(e)
    return rounded(A.score(e, model, 0.33).select("event_id", "p1"))


@query(f"""WITH {HOURLY}, pk AS (SELECT key, ts AS decision_ts, close / 500 AS p1 FROM bars WHERE close / 500 >= 0.4), ex AS (SELECT pk.key, decision_ts, p1, b.ts, b.close, CAST((epoch(b.ts) - epoch(decision_ts)) / 3600 AS BIGINT) AS h FROM pk JOIN bars b ON b.key = pk.key AND b.ts >= decision_ts AND b.ts <= decision_ts + INTERVAL 6 HOUR)
SELECT key, decision_ts, {r6('p1', 'p1')}, ts, {r6('close', 'close')}, h, md5(key || '-' || CAST(CAST(epoch(decision_ts) AS BIGINT) AS VARCHAR)) AS pick_id FROM ex""")
def scored_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir)
    p = F.col("close") / 500
    probs = F.array(F.struct(F.lit(0).alias("label"), (1 - p).alias("prob")), F.struct(F.lit(1).alias("label"), p.alias("prob")))
    picks = b.select("key", F.col("ts").alias("decision_ts"), A.probability_of(probs).alias("p1")).where("p1 >= 0.4")
    return rounded(A.expand_paths(picks, b, 6, price="close").select("key", "decision_ts", "p1", "ts", "close", "h", "pick_id"))
