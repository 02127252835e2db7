"""Distribution features from mergeable states: one row per key and period, with quantile sketches, so that history is read once and any span of periods is merged from its states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.expr import null_if_zero, safe_div
from barloom.operators.rolling import S, Series

#: Size of a sketch: 1,024 keep ranks within about 0.25 % of the number of values, whatever it is, and are exact for fewer values than that.
SIZE = 1024
SKETCHED = ("close", "low", "volume", "body_share", "span")
#: Sums and counts by state: (name, row expression).
_ADDED = {
    "zero_volumes": "CASE WHEN volume IS NULL OR volume = 0 THEN 1 ELSE 0 END", "wicks": "CASE WHEN span > 0 AND body_share <= 0.15 THEN 1 ELSE 0 END", "greens": "CASE WHEN green THEN 1 ELSE 0 END",
    "tiny_moves": "CASE WHEN move IS NULL OR abs(move) < 0.002 THEN 1 ELSE 0 END", "big_moves": "CASE WHEN abs(move) > 0.3 THEN 1 ELSE 0 END", "turns": "CASE WHEN turn THEN 1 ELSE 0 END",
}


def _move(close: Column, before: Column) -> Column:
    return safe_div(close - before, before)


def period_states(bars: DataFrame, period: str = "day", s: Series = S, size: int = SIZE) -> DataFrame:
    """(key, period, state columns): what distribution_of() needs of the bars of a period, which must be whole. States of later periods are appended; none is written again.

    Moves and turns are those inside the period; the first and last bar are kept for those between periods.
    """
    rows = bars.withColumn("period", F.date_trunc(period, s.ts))
    w = Window.partitionBy(s.key, "period").orderBy(s.ts)
    rows = rows.withColumns({"span": F.col("high") - F.col("low"), "green": F.col("close") >= F.col("open"), "_first": F.row_number().over(w) == 1})
    rows = rows.withColumns({"body_share": safe_div(F.abs(F.col("close") - F.col("open")), null_if_zero("span")), "move": _move(F.col("close"), F.lag("close").over(w)), "turn": F.col("green") != F.lag("green").over(w)})
    added = {name: F.expr(x) for name, x in _ADDED.items()}
    for name in ("tiny_moves", "big_moves"):  # the first bar's move isn't known here
        added[name] = F.when(F.col("_first"), 0).otherwise(added[name])
    ends = F.struct("close", "green")
    return rows.groupBy(s.key, "period").agg(
        F.count("*").alias("n"), F.min_by(ends, s.ts).alias("first_bar"), F.max_by(ends, s.ts).alias("last_bar"), F.max(s.ts).alias("last_ts"), *[F.sum(x).alias(name) for name, x in added.items()],
        F.count("close").alias("closes"), F.avg("close").alias("mean_close"), (F.var_pop("close") * F.count("close")).alias("rest_close"), F.min("close").alias("min_close"), F.max("close").alias("max_close"), F.min("low").alias("min_low"),
        F.max("volume").alias("max_volume"), F.sum("span").alias("spans"), F.count("span").alias("n_spans"), F.sum("body_share").alias("body_shares"), F.count("body_share").alias("n_body_shares"),
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), size).alias(f"q_{c}") for c in SKETCHED],
    )


def distribution_of(states: DataFrame, *, since: Column | None = None, until: Column | None = None, least_rows: int = 500, s: Series = S, size: int = SIZE) -> DataFrame:
    """distribution_features() of the periods from since to before until, from their states alone. Quantiles are values of the data, of ranks within the sketch's error."""
    chosen = states
    for bound in (None if since is None else F.col("period") >= since, None if until is None else F.col("period") < until):
        chosen = chosen if bound is None else chosen.where(bound)
    before = F.lag("last_bar").over(Window.partitionBy(s.key).orderBy("period"))
    chosen = chosen.withColumn("_before", before)
    move = _move(F.col("first_bar.close"), F.col("_before.close"))
    between = {"tiny_moves": move.isNull() | (F.abs(move) < 0.002), "big_moves": F.abs(move) > 0.3, "turns": F.col("first_bar.green") != F.col("_before.green")}
    count = lambda name: F.sum(F.col(name) + (F.when(between[name], 1).otherwise(0) if name in between else 0)).alias(name)
    closes = F.sum(F.col("closes") * F.col("mean_close"))
    # Deviations about the mean of means: the squares don't cancel.
    middle = F.avg("mean_close").over(Window.partitionBy(s.key))
    chosen = chosen.withColumn("_shift", F.col("mean_close") - middle)
    shift, squares = F.sum(F.col("closes") * F.col("_shift")), F.sum(F.col("rest_close") + F.col("closes") * F.col("_shift") * F.col("_shift"))
    found = chosen.groupBy(s.key).agg(
        F.sum("n").alias("n"), F.count("*").alias("periods"), F.max("last_ts").alias("last_ts"), *[count(name) for name in _ADDED], safe_div(closes, F.sum("closes")).alias("mean_close"),
        F.when(F.sum("closes") > 1, F.sqrt(F.greatest(squares - shift * shift / F.sum("closes"), F.lit(0.0)) / (F.sum("closes") - 1))).alias("std_close"), F.min("min_close").alias("min_close"), F.max("max_close").alias("max_close"),
        F.min("min_low").alias("min_low"), F.max("max_volume").alias("max_volume"), safe_div(F.sum("spans"), F.sum("n_spans")).alias("mean_span"), safe_div(F.sum("body_shares"), F.sum("n_body_shares")).alias("mean_body_share"),
        *[F.kll_merge_agg_double(f"q_{c}", size).alias(f"q_{c}") for c in SKETCHED],
    ).where(F.col("n") >= least_rows)
    q = lambda c, p: F.when(F.kll_sketch_get_n_double(f"q_{c}") > 0, F.kll_sketch_get_quantile_double(f"q_{c}", F.lit(p)))
    share = lambda name: safe_div(name, "n")
    found = found.withColumns({
        "median_close": q("close", 0.5), "p01_close": q("close", 0.01), "p99_close": q("close", 0.99), "p01_low": q("low", 0.01), "median_volume": q("volume", 0.5), "median_body_share": q("body_share", 0.5), "p05_span": q("span", 0.05), "p95_span": q("span", 0.95),
        "zero_volume_share": share("zero_volumes"), "wick_share": share("wicks"), "green_share": share("greens"), "tiny_move_share": share("tiny_moves"), "big_move_share": share("big_moves"), "turn_share": safe_div("turns", F.col("n") - 1),
    })
    return found.withColumns({
        "close_vol_ratio": safe_div("std_close", "median_close"), "span_ratio": safe_div("mean_span", "median_close"), "p01_low_ratio": safe_div("p01_low", "median_close"), "max_to_min": safe_div("max_close", "min_close"),
        "p01_to_max": safe_div("p01_close", "max_close"), "p01_to_p99": safe_div("p01_close", "p99_close"), "volume_peak_ratio": safe_div("max_volume", null_if_zero("median_volume")), "span_spread": safe_div("p95_span", null_if_zero("p05_span")),
    }).drop(*[f"q_{c}" for c in SKETCHED], *_ADDED)
