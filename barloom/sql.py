"""SQL table functions over a table of ticks: bars, features and what is served, with the options of live and historical runs as arguments.

create_functions(spark) defines temporary functions of the session in SQL alone, so that Catalyst puts their bodies in place and filters reach the scan:

    SELECT * FROM hourly_bars(as_of => TIMESTAMP '2024-01-20', history_hours => 960)
    SELECT * FROM asset_features(as_of => TIMESTAMP '2024-01-20', history_hours => 960, output_hours => 48)
    SELECT * FROM inference_features(as_of => TIMESTAMP '2024-01-20', history_hours => 960, output_hours => 48, members_only => true, least_coverage => 0.9)

as_of is exclusive and stands for the present; NULL takes all there is. Features need history_hours of bars before them; output_hours cuts what comes out, so that a live run reads and
returns little and a historical one, without them, everything.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

_SPAN = "as_of TIMESTAMP DEFAULT NULL, history_hours INT DEFAULT NULL"
_W = "PARTITION BY key ORDER BY ts ROWS BETWEEN {} PRECEDING AND CURRENT ROW"
_W24, _W168 = _W.format(23), _W.format(167)
_FEATURES = "price DOUBLE, volume DOUBLE, ret DOUBLE, logret DOUBLE, mean_24 DOUBLE, std_24 DOUBLE, rv_24 DOUBLE, cumret_24 DOUBLE, cumret_168 DOUBLE, dist_sma_24 DOUBLE, dist_sma_168 DOUBLE, dist_high_168 DOUBLE, next_price DOUBLE"


def _bars(ticks: str, order: str) -> str:
    return f"""CREATE OR REPLACE TEMPORARY FUNCTION hourly_bars({_SPAN})
RETURNS TABLE (key STRING, ts TIMESTAMP, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE)
RETURN SELECT key, date_trunc('hour', CAST(ts AS TIMESTAMP)), min_by(price, {order}), max(price), min(price), max_by(price, {order}), sum(volume) FROM {ticks}
WHERE (as_of IS NULL OR CAST(ts AS TIMESTAMP) < as_of) AND (as_of IS NULL OR history_hours IS NULL OR CAST(ts AS TIMESTAMP) >= as_of - make_interval(0, 0, 0, 0, history_hours))
GROUP BY key, date_trunc('hour', CAST(ts AS TIMESTAMP))"""


def _asset_features() -> str:
    return f"""CREATE OR REPLACE TEMPORARY FUNCTION asset_features({_SPAN}, output_hours INT DEFAULT NULL)
RETURNS TABLE (key STRING, ts TIMESTAMP, {_FEATURES})
RETURN WITH bars AS (SELECT * FROM hourly_bars(as_of, history_hours)),
hours AS (SELECT key, explode(sequence(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM bars GROUP BY key),
grid AS (SELECT hours.key, hours.ts, last_value(close) IGNORE NULLS OVER (PARTITION BY hours.key ORDER BY hours.ts) AS price, coalesce(volume, 0D) AS volume FROM hours LEFT JOIN bars ON bars.key = hours.key AND bars.ts = hours.ts),
lagged AS (SELECT *, lag(price) OVER (PARTITION BY key ORDER BY ts) AS before, lead(price) OVER (PARTITION BY key ORDER BY ts) AS next_price FROM grid),
moved AS (SELECT *, price / nullif(before, 0) - 1 AS ret, CASE WHEN price > 0 AND before > 0 THEN ln(price / before) END AS logret FROM lagged),
found AS (SELECT key, ts, price, volume, ret, logret, avg(ret) OVER ({_W24}) AS mean_24, stddev_samp(ret) OVER ({_W24}) AS std_24, sqrt(sum(coalesce(logret, 0D) * coalesce(logret, 0D)) OVER ({_W24})) * sqrt(24) AS rv_24,
  exp(sum(coalesce(logret, 0D)) OVER ({_W24})) - 1 AS cumret_24, exp(sum(coalesce(logret, 0D)) OVER ({_W168})) - 1 AS cumret_168, price / nullif(avg(price) OVER ({_W24}), 0) - 1 AS dist_sma_24,
  price / nullif(avg(price) OVER ({_W168}), 0) - 1 AS dist_sma_168, price / nullif(max(price) OVER ({_W168}), 0) - 1 AS dist_high_168, next_price FROM moved)
SELECT * FROM found WHERE as_of IS NULL OR output_hours IS NULL OR ts >= as_of - make_interval(0, 0, 0, 0, output_hours)"""


def _inference_features(membership: str) -> str:
    return f"""CREATE OR REPLACE TEMPORARY FUNCTION inference_features({_SPAN}, output_hours INT DEFAULT NULL, members_only BOOLEAN DEFAULT TRUE, least_coverage DOUBLE DEFAULT 0.9D, include_edge BOOLEAN DEFAULT TRUE)
RETURNS TABLE (key STRING, ts TIMESTAMP, {_FEATURES}, univ_n BIGINT, univ_mean_short DOUBLE, univ_share_up DOUBLE, member BOOLEAN)
RETURN WITH f AS (SELECT * FROM asset_features(as_of, history_hours, output_hours)),
u AS (SELECT ts, count(*) AS univ_n, avg(cumret_24) AS univ_mean_short, avg(CASE WHEN cumret_24 > 0 THEN 1D ELSE 0D END) AS univ_share_up FROM f GROUP BY ts),
m AS (SELECT CAST(key AS STRING) AS key, week_start FROM {membership} WHERE member), expected AS (SELECT week_start, count(*) AS members FROM m GROUP BY week_start),
j AS (SELECT f.*, univ_n, univ_mean_short, univ_share_up, m.key IS NOT NULL AS member, members FROM f JOIN u ON u.ts = f.ts LEFT JOIN m ON m.key = f.key AND m.week_start = CAST(date_trunc('week', f.ts) AS DATE)
  LEFT JOIN expected ON expected.week_start = CAST(date_trunc('week', f.ts) AS DATE)),
p AS (SELECT *, sum(CAST(member AS INT)) OVER (PARTITION BY ts) AS present FROM j)
SELECT * EXCEPT (members, present) FROM p WHERE (NOT members_only OR (member AND present >= least_coverage * members)) AND (include_edge OR next_price IS NOT NULL)"""


def create_functions(spark: SparkSession, ticks: str = "ticks", membership: str | None = "membership", tie: tuple[str, ...] = ()) -> None:
    """Defines hourly_bars, asset_features and, with a membership table (key, week_start, member), inference_features over the table or view ticks (key, ts, price, volume and the tie columns)."""
    spark.sql(_bars(ticks, f"struct({', '.join(('ts', *tie))})"))
    spark.sql(_asset_features())
    if membership is not None:
        spark.sql(_inference_features(membership))
