"""Queries over candles, cross-sections, joins and references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.expr import rounded
from barloom.operators import candles as C
from barloom.operators import cross as X
from barloom.operators import joins as J
from barloom.operators import rolling as R
from barloom.plans.adapters import GRID, HOURLY, RETURNS, TICKS, hourly, load, prior, r6, ticks, w
from barloom.plans.registry import query
from barloom.plans.series import _z, base, out

LN2 = "0.6931471805599453"


def _ratio_ln(a: str, b: str) -> str:
    return f"coalesce(CASE WHEN {a} / nullif({b}, 0) > 0 THEN ln({a} / nullif({b}, 0)) END, 0)"


SCALARS = f"""{HOURLY},
s AS (SELECT *, (high + low + close) / 3 AS typical, volume * ((high + low + close) / 3) AS tv, high - low AS span, (high - low) / nullif(close, 0) AS rel_span, {_ratio_ln('high', 'low')} AS log_hl,
  coalesce((2 * close - high - low) / nullif(high - low, 0), 0) AS clv, coalesce(abs(close - open) / nullif(high - low, 0), 0) AS body, coalesce((high - greatest(open, close)) / nullif(high - low, 0), 0) AS uw,
  coalesce((least(open, close) - low) / nullif(high - low, 0), 0) AS lw, {_ratio_ln('close', 'open')} AS log_co, {_ratio_ln('high', 'close')} AS log_hc, {_ratio_ln('high', 'open')} AS log_ho, {_ratio_ln('low', 'close')} AS log_lc, {_ratio_ln('low', 'open')} AS log_lo FROM bars)"""
MOVES = SCALARS + """,
l AS (SELECT *, row_number() OVER o AS i, lag(close) OVER o AS pc, lag(high) OVER o AS ph, lag(low) OVER o AS pl, lag(typical) OVER o AS pt, lag(log_hl) OVER o AS p_hl, (ln(high) + ln(low)) / 2 AS mid FROM s WINDOW o AS (PARTITION BY key ORDER BY ts)),
m AS (SELECT *, lag(mid) OVER (PARTITION BY key ORDER BY ts) AS pmid, ln(close) - ln(pc) AS logret, CASE WHEN pc IS NOT NULL THEN greatest(span, abs(high - pc), abs(low - pc)) END AS tr, open / nullif(pc, 0) - 1 AS gap, CASE WHEN high < ph AND low > pl THEN 1 ELSE 0 END AS inside, abs(close - pc) AS mv,
  CASE WHEN high - ph > pl - low AND high - ph > 0 THEN high - ph ELSE 0 END AS pdm, CASE WHEN pl - low > high - ph AND pl - low > 0 THEN pl - low ELSE 0 END AS mdm, abs(high - pl) AS pvm, abs(low - ph) AS mvm,
  CASE WHEN typical > pt THEN typical * tv ELSE 0 END AS fu, CASE WHEN typical < pt THEN typical * tv ELSE 0 END AS fd, clv * tv AS sv FROM l)"""


def moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.bar_moves(C.scalars(hourly(spark, sf_dir)))


def over_m(columns: dict[str, str], *windows: str, more: str = "", source: str = "m") -> str:
    named = f" WINDOW {', '.join(windows)}" if windows else ""
    return f"WITH {MOVES}{more} SELECT key, ts, {', '.join(r6(x, n) for n, x in columns.items())} FROM {source}{named}"


def _full(n: int, x: str) -> str:
    return f"CASE WHEN i >= {n} THEN {x} END"


W24, W168 = w("w24", 24), w("w168", 168)


@query(f"WITH {TICKS} SELECT key, date_trunc('hour', ts) AS ts, {r6('price', 'price')}, {r6('volume', 'volume')}, event_id FROM ticks QUALIFY row_number() OVER (PARTITION BY key, date_trunc('hour', ts) ORDER BY volume DESC, event_id) = 1")
def widest_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).withColumn("ts", F.date_trunc("hour", "ts"))
    return out(C.widest_listing(t, tie=["event_id"]), "price", "volume", "event_id")


_SCALAR = {"typical": "typical", "typical_volume": "tv", "rel_span": "rel_span", "log_hl": "log_hl", "clv": "clv", "body": "body", "upper_wick": "uw", "lower_wick": "lw", "log_co": "log_co", "log_hc": "log_hc", "log_ho": "log_ho", "log_lc": "log_lc", "log_lo": "log_lo"}


@query(over_m(_SCALAR))
def candle_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(C.scalars(hourly(spark, sf_dir)), *_SCALAR)


_MOVE = {"true_range": "tr", "rel_true_range": "tr / nullif(pc, 0)", "gap": "gap", "move": "mv", "plus_dm": "pdm", "minus_dm": "mdm", "plus_vm": "pvm", "minus_vm": "mvm", "flow_up": "fu", "flow_down": "fd", "signed_volume": "sv"}


@query(over_m(_MOVE))
def bar_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(moves(spark, sf_dir), *_MOVE)


_K = "(3 - 2 * sqrt(2))"
_SPREAD = f""", a AS (SELECT *, CASE WHEN p_hl IS NOT NULL THEN (sqrt(2 * (power(log_hl, 2) + power(p_hl, 2))) - sqrt(power(log_hl, 2) + power(p_hl, 2))) / {_K} - sqrt(power(coalesce(CASE WHEN ph IS NOT NULL AND greatest(high, ph) / nullif(least(low, pl), 0) > 0 THEN ln(greatest(high, ph) / least(low, pl)) END, 0), 2) / {_K}) END AS al FROM m),
b AS (SELECT *, CASE WHEN al <= 0 THEN 0 ELSE 2 * (exp(al) - 1) / (1 + exp(al)) END AS cs, (ln(pc) - pmid) * (ln(pc) - mid) AS ar FROM a),
d AS (SELECT *, {_full(25, 'avg(cs) OVER w24 * 10000')} AS cs24, {_full(25, '2 * sqrt(greatest(avg(ar) OVER w24, 0)) * 10000')} AS ar24 FROM b WINDOW {W24})"""


@query(over_m({"cs_spread_24": "cs24", "ar_spread_24": "ar24", "cs_spread_z_168": _full(192, _z("cs24", "w168"))}, W168, more=_SPREAD, source="d"))
def spread_estimators(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(C.spreads(moves(spark, sf_dir)), "cs_spread_24", "ar_spread_24", "cs_spread_z_168")


_FLOW = {k: v for n in (24, 168) for k, v in {
    f"clv_mean_{n}": _full(n, f"avg(clv) OVER w{n}"), f"flow_imbalance_{n}": _full(n, f"sum(sv) OVER w{n} / nullif(sum(tv) OVER w{n}, 0)"),
    f"vwap_dist_{n}": _full(n, f"ln(close / (sum(typical * tv) OVER w{n} / nullif(sum(tv) OVER w{n}, 0)))")}.items()} | {
    "wick_asymmetry_24": _full(24, "avg(lw - uw) OVER w24"), "mfi_24": _full(25, "100 * sum(fu) OVER w24 / nullif(sum(fu) OVER w24 + sum(fd) OVER w24, 0)")}


@query(over_m(_FLOW, W24, W168))
def order_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(C.flows(moves(spark, sf_dir)), *_FLOW)


_ATR = {n: _full(n + 1, f"avg(tr / nullif(pc, 0)) OVER w{n}") for n in (24, 168)}
_PARK = {n: _full(n, f"sqrt(avg(log_hl * log_hl) OVER w{n} / (4 * {LN2}))") for n in (24, 168)}
_RANGE = {"atr_24": _ATR[24], "atr_168": _ATR[168], "atr_ratio": f"({_ATR[24]}) / nullif(({_ATR[168]}), 0)", "parkinson_24": _PARK[24], "parkinson_168": _PARK[168],
    "garman_klass_24": _full(24, f"sqrt(greatest(avg(0.5 * log_hl * log_hl - (2 * {LN2} - 1) * log_co * log_co) OVER w24, 0))"), "rogers_satchell_24": _full(24, "sqrt(greatest(avg(log_hc * log_ho + log_lc * log_lo) OVER w24, 0))")}


@query(over_m(_RANGE, W24, W168))
def range_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(C.range_volatility(moves(spark, sf_dir)), *_RANGE)


_TRUE = {k: v for n in (24, 168) for k, v in {
    f"true_high_{n}": _full(n, f"ln(close / max(high) OVER w{n})"), f"true_low_{n}": _full(n, f"ln(close / min(low) OVER w{n})"), f"true_place_{n}": _full(n, f"(close - min(low) OVER w{n}) / nullif(max(high) OVER w{n} - min(low) OVER w{n}, 0)"),
    f"true_break_high_{n}": _full(n + 1, f"CASE WHEN close > max(high) OVER p{n} THEN 1 ELSE 0 END"), f"true_break_low_{n}": _full(n + 1, f"CASE WHEN close < min(low) OVER p{n} THEN 1 ELSE 0 END")}.items()}


@query(over_m(_TRUE, W24, W168, prior("p24", 24), prior("p168", 168)))
def true_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(C.true_extremes(moves(spark, sf_dir)), *_TRUE)


_SQUEEZE = f", q AS (SELECT *, {_ATR[24]} AS atr FROM m WINDOW {W24}), v AS (SELECT *, list(rel_span) OVER w24 AS a24, list_filter(list(atr) OVER w240, lambda x: x IS NOT NULL) AS a240 FROM q WINDOW {W24}, {w('w240', 240)})"


@query(over_m({"range_z": _full(24, _z("rel_span", "w24")), "narrow_rank": "CASE WHEN len(a24) >= 24 THEN len(list_filter(a24, lambda x: x <= rel_span)) / 24.0 END", "squeeze_rank": "CASE WHEN len(a240) >= 240 AND atr IS NOT NULL THEN len(list_filter(a240, lambda x: x <= atr)) / 240.0 END"}, W24, more=_SQUEEZE, source="v"))
def range_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(C.compression(C.range_volatility(moves(spark, sf_dir)), long=240), "range_z", "narrow_rank", "squeeze_rank")


_SINCE = f", g AS (SELECT *, max(high) OVER w168 AS top FROM m WINDOW {W168}), v AS (SELECT g.key, g.ts, g.i, max(x.i) AS top_i FROM g JOIN m x ON x.key = g.key AND x.i BETWEEN g.i - 167 AND g.i AND x.high = g.top GROUP BY g.key, g.ts, g.i)"


@query(over_m({"since_high_168": "CASE WHEN i >= 168 THEN (i - top_i) / 168.0 END"}, more=_SINCE, source="v"))
def bars_since_high(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(C.since_high(moves(spark, sf_dir)), "since_high_168")


@query(over_m({"inside_run": "least(i - coalesce(max(CASE WHEN inside = 0 THEN i END) OVER u, 0), 6)"}, "u AS (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING)"))
def inside_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(C.inside_run(moves(spark, sf_dir)), "inside_run")


def _di(x: str, n: int) -> str:
    return f"(100 * sum({x}) OVER w{n} / nullif(sum(tr) OVER w{n}, 0))"


def _dx(n: int) -> str:
    return f"100 * abs({_di('pdm', n)} - {_di('mdm', n)}) / nullif({_di('pdm', n)} + {_di('mdm', n)}, 0)"


_DIR = f""", e AS (SELECT *, {_dx(24)} AS dx24, {_dx(168)} AS dx168, {_di('pdm', 24)} - {_di('mdm', 24)} AS dd, {_full(169, f'100 * ln(sum(tr) OVER w168 / nullif(max(high) OVER w168 - min(low) OVER w168, 0)) / ln(168)')} AS ch,
{_full(25, 'sum(pvm) OVER w24 / nullif(sum(tr) OVER w24, 0) - sum(mvm) OVER w24 / nullif(sum(tr) OVER w24, 0)')} AS vo, {_full(25, 'abs(close - lag(close, 24) OVER (PARTITION BY key ORDER BY ts)) / nullif(sum(mv) OVER w24, 0)')} AS e24 FROM m WINDOW {W24}, {W168})"""


@query(over_m({"dx_24": "dx24", "di_diff": "dd", "adx_24": _full(48, "avg(dx24) OVER w24"), "adx_168": _full(336, "avg(dx168) OVER w168"), "choppiness_168": "ch", "vortex_24": "vo", "efficiency_24": "e24"}, W24, W168, more=_DIR, source="e"))
def directional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(C.directional(moves(spark, sf_dir)), "dx_24", "di_diff", "adx_24", "adx_168", "choppiness_168", "vortex_24", "efficiency_24")


def _slope(y: str, n: int) -> str:
    return _full(n, f"covar_pop({y}, CAST(i AS DOUBLE)) OVER w{n} / nullif(var_pop(CAST(i AS DOUBLE)) OVER w{n}, 0)")


_ADL = f""", p1 AS (SELECT *, sv / nullif(sum(tv) OVER w24, 0) AS part FROM m WINDOW {W24}), p2 AS (SELECT *, sum(part) OVER u AS adl, sum(logret) OVER u AS lp FROM p1 WINDOW u AS (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING)),
p3 AS (SELECT *, {_slope('adl', 48)} AS sa, {_slope('lp', 48)} AS sp FROM p2 WINDOW {w('w48', 48)})"""


@query(over_m({"accumulation": "adl", "accumulation_slope_48": "sa", "accumulation_divergence": _full(240, f"{_z('sa', 'w240')} - {_z('sp', 'w240')}")}, w("w240", 240), more=_ADL, source="p3"))
def accumulation_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(C.accumulation(moves(spark, sf_dir), n=48, z=240), "accumulation", "accumulation_slope_48", "accumulation_divergence")


_GAP = {"gap_mean_24": _full(25, "avg(abs(gap)) OVER w24"), "gap_max_168": _full(169, "max(abs(gap)) OVER w168"), "flat_share_24": _full(24, "avg(CASE WHEN high = low THEN 1.0 ELSE 0.0 END) OVER w24"), "range_impact_24": _full(24, "avg(rel_span / nullif(tv, 0)) OVER w24"),
    "upper_wick_mean_24": _full(24, "avg(uw) OVER w24"), "lower_wick_mean_24": _full(24, "avg(lw) OVER w24"), "upper_wick_max_24": _full(24, "max(uw) OVER w24"), "body_mean_24": _full(24, "avg(body) OVER w24")}


@query(over_m(_GAP, W24, W168))
def gap_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(C.gap_stats(moves(spark, sf_dir)), *_GAP)


@query(over_m({"rv_efficiency": f"CASE WHEN count(*) OVER w24 = 24 THEN sqrt(avg(logret * logret) OVER w24) / nullif({_PARK[24]}, 0) END"}, W24))
def volatility_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(C.efficiency_of_volatility(C.range_volatility(moves(spark, sf_dir))), "rv_efficiency")


# Cross-sections.
FEATURES = RETURNS + f""",
f AS (SELECT *, exp(sum(lr) OVER w24) - 1 AS cumret_24, exp(sum(lr) OVER w168) - 1 AS cumret_168, price / nullif(avg(price) OVER w24, 0) - 1 AS dist_sma_24, price / nullif(avg(price) OVER w168, 0) - 1 AS dist_sma_168,
  price / nullif(max(price) OVER w168, 0) - 1 AS dist_high_168, sqrt(sum(lr * lr) OVER w24) * sqrt(24) AS rv_24 FROM r WINDOW {W24}, {W168})"""
STATS = FEATURES + """,
u AS (SELECT ts, count(*) AS univ_n, median(cumret_24) AS univ_median_short, avg(cumret_24) AS univ_mean_short, stddev_samp(cumret_24) AS univ_dispersion_short, median(cumret_168) AS univ_median_long,
  avg(CASE WHEN cumret_24 > 0 THEN 1.0 ELSE 0.0 END) AS univ_share_up, avg(CASE WHEN dist_sma_24 > 0 THEN 1.0 ELSE 0.0 END) AS univ_share_above_24, avg(CASE WHEN dist_sma_168 > 0 THEN 1.0 ELSE 0.0 END) AS univ_share_above_168,
  avg(CASE WHEN dist_high_168 < -0.1 THEN 1.0 ELSE 0.0 END) AS univ_share_deep, median(rv_24) AS univ_median_rv FROM f GROUP BY ts)"""
_STAT = ["univ_median_short", "univ_mean_short", "univ_dispersion_short", "univ_median_long", "univ_share_up", "univ_share_above_24", "univ_share_above_168", "univ_share_deep", "univ_median_rv"]


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = R.realized_vol(R.cumulative_return(base(spark, sf_dir)), (24,))
    return R.extremes(R.moving_averages(df, (24, 168), macd=None, spread=None), (168,))


@query(f"WITH {STATS} SELECT ts, univ_n, {', '.join(r6(c, c) for c in _STAT)} FROM u")
def universe_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(X.universe_stats(features(spark, sf_dir)))


_TIME = "PARTITION BY 1 ORDER BY ts ROWS BETWEEN 239 PRECEDING AND CURRENT ROW"


@query(f"WITH {STATS} SELECT ts, {r6('CASE WHEN count(univ_median_rv) OVER t = 240 THEN ' + _z('univ_median_rv', 't') + ' END', 'univ_median_rv_z_240')} FROM u WINDOW t AS ({_TIME})")
def regime_z_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(X.regime_z(X.universe_stats(features(spark, sf_dir)), n=240).select("ts", "univ_median_rv_z_240"))


@query(f"WITH {STATS}, v AS (SELECT ts, x, list(x) OVER t AS a FROM (SELECT ts, round(univ_median_rv + 2.3e-8, 6) AS x FROM u) WINDOW t AS ({_TIME})) SELECT ts, {r6('CASE WHEN len(a) = 240 THEN len(list_filter(a, lambda y: y < x)) / 239.0 END', 'univ_median_rv_pct_240')} FROM v")
def trailing_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(X.trailing_percentile(rounded(X.universe_stats(features(spark, sf_dir))), "univ_median_rv", 240).select("ts", "univ_median_rv_pct_240"))


@query(f"WITH {FEATURES} SELECT key, ts, {', '.join(r6(f'percent_rank() OVER (PARTITION BY ts ORDER BY {c} NULLS FIRST)', f'rank_{c}') for c in ('cumret_24', 'cumret_168', 'dollar_volume'))} FROM f")
def percent_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return out(X.percent_ranks(features(spark, sf_dir), ["cumret_24", "cumret_168", "dollar_volume"]), "rank_cumret_24", "rank_cumret_168", "rank_dollar_volume")


@query(f"WITH {STATS}, ref AS (SELECT ts, cumret_24 AS rc FROM f WHERE key = 'purchase') SELECT f.key, f.ts, {r6('cumret_24 - coalesce(univ_median_short, 0)', 'cumret_24_over_median')}, {r6('cumret_24 - coalesce(rc, 0)', 'cumret_24_over_reference')} FROM f LEFT JOIN u USING (ts) LEFT JOIN ref USING (ts)")
def excess_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features(spark, sf_dir)
    block = X.reference_block(df, "purchase", ["cumret_24"], "ref_")
    joined = X.with_references(df, [X.universe_stats(df), block])
    return out(X.excess(joined, "cumret_24", {"median": "univ_median_short", "reference": "ref_cumret_24"}), "cumret_24_over_median", "cumret_24_over_reference")


_INDEX = f"""{RETURNS}, x AS (SELECT ts, avg(logret) AS idx_logret FROM r WHERE logret IS NOT NULL GROUP BY ts),
y AS (SELECT ts, idx_logret, CASE WHEN count(*) OVER t = 168 THEN sum(idx_logret) OVER t END AS idx_cumret_168, CASE WHEN count(*) OVER t = 168 THEN var_pop(idx_logret) OVER t END AS idx_var_168 FROM x WINDOW t AS (ORDER BY ts ROWS BETWEEN 167 PRECEDING AND CURRENT ROW))"""


@query(f"WITH {_INDEX} SELECT ts, {', '.join(r6(c, c) for c in ('idx_logret', 'idx_cumret_168', 'idx_var_168'))} FROM y")
def equal_weight_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(X.equal_weight_index(base(spark, sf_dir), (168,)))


@query(f"WITH {_INDEX}, k AS (SELECT ts, CASE WHEN count(*) OVER w168 = 168 THEN var_pop(lr) OVER w168 END AS v FROM r WINDOW {W168}), z AS (SELECT ts, avg(v) AS mv FROM k GROUP BY ts) SELECT y.ts, {r6('idx_var_168 / nullif(mv, 0)', 'herding_168')} FROM y LEFT JOIN z USING (ts)")
def herding_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = base(spark, sf_dir)
    return rounded(X.herding(df, X.equal_weight_index(df, (168,))).select("ts", "herding_168"))


@query(f"WITH {FEATURES}, ref AS (SELECT ts, ret AS ref_ret, cumret_24 AS ref_cumret_24, rv_24 AS ref_rv_24 FROM f WHERE key = 'view') SELECT f.key, f.ts, {r6('ref_ret', 'ref_ret')}, {r6('ref_cumret_24', 'ref_cumret_24')}, {r6('ref_rv_24', 'ref_rv_24')} FROM f LEFT JOIN ref USING (ts)")
def reference_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features(spark, sf_dir)
    return out(X.with_references(df, [X.reference_block(df, "view", ["ret", "cumret_24", "rv_24"], "ref_")]), "ref_ret", "ref_cumret_24", "ref_rv_24")


_LONG = RETURNS + f""", i AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts) AS i FROM r), g AS (SELECT ts, CASE WHEN i >= 96 THEN price / avg(price) OVER w96 - 1 END AS d, CASE WHEN i >= 96 THEN price / max(price) OVER w96 - 1 END AS h, CASE WHEN i >= 96 THEN exp(sum(lr) OVER w96) - 1 END AS c FROM i WINDOW {w('w96', 96)})"""


@query(f"WITH {_LONG} SELECT ts, {r6('avg(CASE WHEN d > 0 THEN 1.0 WHEN d IS NOT NULL THEN 0.0 END)', 'breadth_above_sma')}, {r6('avg(CASE WHEN h > -0.05 THEN 1.0 WHEN h IS NOT NULL THEN 0.0 END)', 'breadth_near_high')}, {r6('median(c)', 'breadth_median_return')} FROM g GROUP BY ts")
def market_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(X.breadth(R.horizons(base(spark, sf_dir), (96,), 480), n=96))


_CANDLES = _SPREAD + f""", q AS (SELECT key, ts, i, cs24, {_FLOW['clv_mean_24']} AS clv24, {_FLOW['flow_imbalance_24']} AS flow24, {_TRUE['true_break_high_24']} AS bh, {_TRUE['true_break_low_24']} AS bl, {_ATR[24]} AS atr, {_ATR[168]} AS atr_long FROM d WINDOW {W24}, {W168}, {prior('p24', 24)}),
v AS (SELECT *, list_filter(list(atr) OVER w240, lambda x: x IS NOT NULL) AS a240 FROM q WINDOW {w('w240', 240)}), sq AS (SELECT *, CASE WHEN len(a240) >= 240 AND atr IS NOT NULL THEN len(list_filter(a240, lambda x: x <= atr)) / 240.0 END AS squeeze FROM v)"""


@query(f"WITH {MOVES}{_CANDLES} SELECT ts, {r6('median(clv24)', 'breadth_clv')}, {r6('median(flow24)', 'breadth_flow')}, {r6('avg(bh)', 'breadth_break_high')}, {r6('avg(bl)', 'breadth_break_low')}, {r6('median(atr / nullif(atr_long, 0))', 'breadth_atr_ratio')}, {r6('avg(CASE WHEN squeeze < 0.25 THEN 1.0 ELSE 0.0 END)', 'breadth_squeezed')}, {r6('median(cs24)', 'breadth_spread')} FROM sq GROUP BY ts")
def candle_breadth(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = C.flows(C.true_extremes(C.range_volatility(C.spreads(moves(spark, sf_dir)))))
    return rounded(X.candle_breadth(C.compression(m, long=240)))


@query(f"""WITH {STATS}, nx AS (SELECT *, lead(price) OVER (PARTITION BY key ORDER BY ts) AS next_price FROM f), ref AS (SELECT ts, cumret_24 AS ref_cumret_24 FROM f WHERE key = 'view')
SELECT nx.key, nx.ts, {r6('nx.price', 'price')}, {r6('next_price', 'next_price')}, univ_n, {r6('univ_median_short', 'univ_median_short')}, {r6('ref_cumret_24', 'ref_cumret_24')} FROM nx LEFT JOIN u USING (ts) LEFT JOIN ref USING (ts)
WHERE next_price IS NOT NULL AND nx.ts >= TIMESTAMP '2024-01-20' AND nx.key <> 'error' AND (SELECT count(*) FROM f g WHERE g.ts = nx.ts AND g.key <> 'error') >= 0.9 * (SELECT count(DISTINCT g.key) FROM f g WHERE g.key <> 'error' AND date_trunc('week', g.ts) = date_trunc('week', nx.ts))""")
def serving_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features(spark, sf_dir)
    weeks = df.where("key <> 'error'").select("key", F.to_date(F.date_trunc("week", "ts")).alias("week_start")).distinct().withColumn("member", F.lit(True))
    block = X.reference_block(df, "view", ["cumret_24"], "ref_")
    served = X.serving_contract(R.next_bar(df), X.universe_stats(df), [block], weeks, members_only=True, include_edge=False, since=F.lit("2024-01-20").cast("timestamp"))
    return out(served, "price", "next_price", "univ_n", "univ_median_short", "ref_cumret_24")


# Joins.
_ENTRY = f"{HOURLY}, e AS (SELECT key, ts AS entry_ts FROM bars WHERE hour(ts) = 6)"


@query(f"WITH {_ENTRY} SELECT e.key, entry_ts, ts, {r6('close', 'close')} FROM e JOIN bars ON bars.key = e.key AND ts > entry_ts AND ts <= entry_ts + INTERVAL 12 HOUR")
def interval_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir)
    entries = b.where(F.hour("ts") == 6).select("key", F.col("ts").alias("entry_ts"))
    return rounded(J.interval_join(entries, b.select("key", "ts", "close"), key=["key"], left_ts="entry_ts", right_ts="ts", low_seconds=0, high_seconds=12 * 3600, low_open=True))


@query(f"WITH {HOURLY}, q AS (SELECT key, ts, close FROM bars WHERE key = 'view'), a AS (SELECT b.key, b.ts, q.ts AS seen_ts, q.close AS seen, row_number() OVER (PARTITION BY b.key, b.ts ORDER BY q.ts DESC) AS n FROM bars b LEFT JOIN q ON q.ts < b.ts) SELECT key, ts, seen_ts, {r6('seen', 'seen')} FROM a WHERE n = 1")
def asof_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir).select("key", "ts").withColumn("g", F.lit(1))
    ref = hourly(spark, sf_dir).where("key = 'view'").select(F.lit(1).alias("g"), F.col("ts").alias("seen_ts"), F.col("close").alias("seen"))
    return rounded(J.asof_join(b, ref, key=["g"], left_ts="ts", right_ts="seen_ts", strict=True).drop("g"))


@query(f"WITH {HOURLY}, h AS (SELECT * FROM bars WHERE ts < TIMESTAMP '2024-01-15'), v AS (SELECT * FROM bars WHERE ts >= TIMESTAMP '2024-01-10') SELECT key, ts, {r6('close', 'close')} FROM h UNION ALL SELECT key, ts, {r6('close', 'close')} FROM v WHERE ts > (SELECT max(ts) FROM h)")
def spliced_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir).select("key", "ts", "close")
    return rounded(J.splice(b.where("ts < '2024-01-15'"), b.where("ts >= '2024-01-10'")))


@query(f"WITH {HOURLY} SELECT key, ts, {r6('CASE WHEN hour(ts) = 3 THEN high ELSE close END', 'close')} FROM bars")
def overridden_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir)
    fixes = b.where(F.hour("ts") == 3).select("key", "ts", F.col("high").alias("close"))
    return rounded(J.apply_overrides(b.select("key", "ts", "close"), fixes, ["key", "ts"], ["close"]))


@query(f"""WITH {HOURLY}, a AS (SELECT key, ts, volume FROM bars WHERE hour(ts) <> 5), b AS (SELECT key, ts, CASE WHEN hour(ts) = 7 THEN volume + 1 ELSE volume END AS volume FROM bars WHERE hour(ts) <> 9)
SELECT key, ts, {r6('a.volume', 'volume_left')}, {r6('b.volume', 'volume_right')}, CASE WHEN a.volume IS NULL THEN 'missing_left' WHEN b.volume IS NULL THEN 'missing_right' ELSE 'volume' END AS reason FROM a FULL JOIN b USING (key, ts) WHERE a.volume IS DISTINCT FROM b.volume""")
def reconciled_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir).select("key", "ts", "volume")
    other = b.where(F.hour("ts") != 9).withColumn("volume", F.when(F.hour("ts") == 7, F.col("volume") + 1).otherwise(F.col("volume")))
    return rounded(J.reconcile(b.where(F.hour("ts") != 5), other, ["key", "ts"], ["volume"]))


@query(f"WITH {HOURLY} SELECT key, ts, {r6('CASE WHEN hour(ts) % 2 = 0 THEN close ELSE open END', 'price')} FROM bars WHERE hour(ts) % 2 = 0 OR hour(ts) % 3 = 0")
def preferred_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir)
    first = b.where(F.hour("ts") % 2 == 0).select("key", "ts", F.col("close").alias("price"))
    second = b.where((F.hour("ts") % 2 == 0) | (F.hour("ts") % 3 == 0)).select("key", "ts", F.col("open").alias("price"))
    return rounded(J.prefer([first, second], ["key", "ts"], ["price"]))


@query(f"WITH {HOURLY} SELECT key, ts, {r6('CASE WHEN hour(ts) < 12 THEN close ELSE open END', 'price')} FROM bars")
def backfilled_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir)
    primary = b.where(F.hour("ts") < 12).select("key", "ts", F.col("close").alias("price"))
    return rounded(J.backfill(primary, b.select("key", "ts", F.col("open").alias("price")), ["key", "ts"]))


@query(f"WITH {RETURNS}, a AS (SELECT key, ts, avg(price) OVER w24 AS sma FROM r WINDOW {W24}), b AS (SELECT ts, avg(ret) AS mean_ret FROM r GROUP BY ts), c AS (SELECT key, max(price) AS top FROM r GROUP BY key) SELECT r.key, r.ts, {r6('sma', 'sma')}, {r6('mean_ret', 'mean_ret')}, {r6('top', 'top')} FROM r LEFT JOIN a USING (key, ts) LEFT JOIN b USING (ts) LEFT JOIN c USING (key)")
def feature_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = base(spark, sf_dir)
    sma = R.moving_averages(df, (24,), macd=None, spread=None).select("key", "ts", F.col("sma_24").alias("sma"))
    blocks = [(sma, ["key", "ts"]), (df.groupBy("ts").agg(F.avg("ret").alias("mean_ret")), ["ts"]), (df.groupBy("key").agg(F.max("price").alias("top")), ["key"])]
    return rounded(J.star(df.select("key", "ts"), blocks))


@query(f"WITH {GRID} SELECT key, ts, min(CASE WHEN price > 100 THEN ts END) OVER (PARTITION BY key ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_ts FROM grid")
def next_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barloom.plans.adapters import grid

    return J.next_event(grid(spark, sf_dir), F.col("price") > 100, key=["key"], ts="ts").select("key", "ts", "next_ts")


@query(f"""WITH {RETURNS}, edges AS (SELECT DISTINCT date_trunc('week', ts) AS run_ts, key, CASE WHEN key = 'view' THEN 'click' ELSE 'view' END AS leader FROM r UNION SELECT DISTINCT date_trunc('week', ts), key, 'purchase' FROM r WHERE key <> 'purchase'),
d AS (SELECT r.key, r.ts, max(e.run_ts) AS run_ts FROM r JOIN (SELECT DISTINCT key, run_ts FROM edges) e ON e.key = r.key AND e.run_ts < date_trunc('day', r.ts) GROUP BY r.key, r.ts),
m AS (SELECT d.key, d.ts, avg(x.ret) AS leader_mean, count(x.ret) AS leader_count FROM d JOIN edges e ON e.key = d.key AND e.run_ts = d.run_ts JOIN r x ON x.key = e.leader AND x.ts = d.ts GROUP BY d.key, d.ts)
SELECT r.key, r.ts, {r6('leader_mean', 'leader_mean')}, leader_count FROM r LEFT JOIN m USING (key, ts)""")
def leaders_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = base(spark, sf_dir)
    weeks = df.select(F.date_trunc("week", "ts").alias("run_ts"), "key").distinct()
    edges = weeks.withColumn("leader", F.when(F.col("key") == "view", "click").otherwise("view")).union(weeks.where("key <> 'purchase'").withColumn("leader", F.lit("purchase"))).distinct()
    return out(J.leaders_returns(df, edges), "leader_mean", "leader_count")


@query("SELECT 'customer' AS entity, c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL FROM supplier")
def united_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return J.union_entities({"customer": c, "supplier": s})


