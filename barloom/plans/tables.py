"""Queries over sources, incremental loads, data-quality checks and streaming forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.expr import rounded, surrogate_key, text_key
from barloom.operators import quality as Q
from barloom.operators import rolling as R
from barloom.operators import universe as U
from barloom.plans.adapters import HOURLY, RETURNS, TICKS, hourly, load, r6, ticks
from barloom.plans.events import STATE, WEEKLY, state, universe_bars
from barloom.plans.registry import query
from barloom.plans.sections import STATS, features
from barloom.plans.series import base
from barloom.sources import tables as S
from barloom.streaming import bars as B


# Sources.
@query("SELECT event_type AS key, to_timestamp(floor(epoch(ts))) AT TIME ZONE 'UTC' AS ts, CAST(value AS DECIMAL(38,9)) AS close FROM events WHERE value > 10")
def flattened_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a nested payload per day, flattened again."""
    e = load(spark, sf_dir, "events")
    item = F.struct(F.col("event_type").alias("address"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("unixTime"), F.col("value").cast("string").alias("c"))
    payload = e.groupBy(F.to_date("ts").alias("day"), (F.col("event_id") % 16).alias("part")).agg(F.struct(F.collect_list(item).alias("items")).alias("data"))
    return S.flatten_items(payload, "data.items", {k: S.BAR_ITEMS[k] for k in ("key", "ts", "close")}, valid=F.col("close") > 10)


@query("SELECT event_id, to_timestamp(floor(epoch(ts))) AT TIME ZONE 'UTC' AS ts, value AS price FROM events WHERE event_id % 4 <> 3")
def sniffed_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Epochs in seconds, milliseconds and microseconds, and one too small to be a time."""
    s = F.unix_seconds(F.col("ts").cast("timestamp")).cast("double")
    unit = F.col("event_id") % 4
    e = load(spark, sf_dir, "events").select("event_id", F.when(unit == 0, s).when(unit == 1, s * 1e3).when(unit == 2, s * 1e6).otherwise(5.0).alias("ts"), F.col("value").alias("price"))
    return S.clean_epoch_prices(e)


@query("SELECT r_regionkey AS id, r_name AS label FROM region WHERE r_regionkey > 0")
def renamed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return S.rename_positional(r, ["id", "label"], F.col("id") > 0)


@query("SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '-' || CASE WHEN o_orderkey % 3 = 0 THEN '_null_' ELSE o_orderstatus END) AS id, CAST(o_orderkey AS VARCHAR) || '-' || o_orderstatus AS full_key FROM orders")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    return o.select("o_orderkey", surrogate_key("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus"))).alias("id"), text_key("o_orderkey", "o_orderstatus").alias("full_key"))


# Incremental loads: the target is the first part of the events, the incoming batch overlaps it.
_TARGET, _INCOMING = "SELECT event_id, user_id, ts, value FROM events WHERE event_id % 10 < 7", "SELECT event_id, user_id, ts, value + 1 AS value FROM events WHERE event_id % 10 >= 5"


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").where("event_id % 10 < 7").select("event_id", "user_id", "ts", "value")


def incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").where("event_id % 10 >= 5").select("event_id", "user_id", "ts", (F.col("value") + 1).alias("value"))


@query("SELECT event_id, user_id, ts, value + 1 AS value FROM events WHERE event_id % 10 >= 7")
def appended_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = incoming(spark, sf_dir)
    return S.append_new(target(spark, sf_dir), batch.unionByName(batch), ["event_id"])


@query("SELECT event_id, user_id, ts, CASE WHEN event_id % 10 >= 5 THEN value + 1 ELSE value END AS value FROM events")
def upserted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.upsert(target(spark, sf_dir), incoming(spark, sf_dir), ["event_id"], ["value"])


@query("SELECT event_id, user_id, ts, CASE WHEN event_id % 10 >= 7 OR (event_id % 10 >= 5 AND ts >= TIMESTAMP '2024-01-24') THEN value + 1 ELSE value END AS value FROM events WHERE event_id % 10 < 7 OR event_id % 10 >= 7")
def upserted_recent_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the last week of the target is open to updates; incoming rows for older ones are held back."""
    recent = F.col("ts") >= F.lit("2024-01-24").cast("timestamp_ntz")
    new = incoming(spark, sf_dir).where(recent | (F.col("event_id") % 10 >= 7))
    return S.upsert(target(spark, sf_dir), new, ["event_id"], ["value"], since=recent)


@query("WITH t AS (SELECT user_id, max(ts) AS m FROM events WHERE ts < TIMESTAMP '2024-01-20' AND user_id % 7 <> 0 GROUP BY user_id) SELECT event_id, e.user_id, ts FROM events e LEFT JOIN t ON t.user_id = e.user_id WHERE m IS NULL OR ts > m")
def rows_after_key_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return S.after_watermark(e, e.where("ts < timestamp_ntz '2024-01-20' AND user_id % 7 <> 0"), "user_id")


@query("SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20') - INTERVAL 6 HOUR")
def rows_after_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("event_id", "ts")
    return S.after_global_watermark(e, e.where("ts < timestamp_ntz '2024-01-20'"), overlap="6 HOURS")


# Quality.
@query(f"WITH {RETURNS} SELECT key, ts, CASE WHEN ret IS NULL THEN 1 ELSE 0 END + CASE WHEN prev_ret IS NULL THEN 1 ELSE 0 END AS n_null FROM r WHERE ret IS NULL OR prev_ret IS NULL")
def null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.not_null(base(spark, sf_dir), ["price", "ret", "prev_ret"]).select("key", "ts", F.size("null_columns").alias("n_null"))


_COUNTS = f"{STATE}, st AS (SELECT week_start, count(CASE WHEN member THEN 1 END) AS members, count(CASE WHEN member AND NOT was THEN 1 END) AS entered, count(CASE WHEN was AND NOT member THEN 1 END) AS exited FROM us GROUP BY week_start), sb AS (SELECT *, lag(members) OVER (ORDER BY week_start) AS before FROM st)"


@query(f"WITH {_COUNTS} SELECT week_start, members, before FROM sb WHERE NOT members BETWEEN 5 AND 30 OR coalesce(members < 0.8 * before, false)")
def member_band_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.member_count_band(state(spark, sf_dir), 5, 30)


@query(f"WITH {STATE} SELECT key, week_start FROM us WHERE (member AND (low_cap_streak >= 1 OR bad_volume_streak >= 1) AND was) OR (was AND NOT member AND NOT (low_cap_streak >= 1 OR bad_volume_streak >= 1))")
def hysteresis_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.hysteresis(state(spark, sf_dir), 1, 1).select("key", "week_start")


@query(f"WITH {_COUNTS} SELECT week_start, members FROM st WHERE members > 10")
def cap_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.cap_respected(state(spark, sf_dir), 10)


@query(f"WITH {WEEKLY}, lu AS (SELECT key, week, max(ts) + CASE WHEN key % 10 = 0 THEN INTERVAL 40 DAY ELSE INTERVAL 0 DAY END AS used FROM ub JOIN wk ON week > ts AND week <= ts + INTERVAL 30 DAY GROUP BY key, week) SELECT key, CAST(week AS DATE) AS week_start, used FROM lu WHERE used >= week")
def look_ahead_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barloom.operators.joins import weeks_served

    used = weeks_served(universe_bars(spark, sf_dir)).groupBy("key", "week_start").agg(F.max("ts").alias("used"))
    used = used.withColumn("used", F.when(F.col("key") % 10 == 0, F.col("used") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("used")))
    return Q.no_look_ahead(used, "used").select("key", "week_start", "used")


@query("SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, CAST(2 AS BIGINT) AS n_version FROM events GROUP BY 1 HAVING bool_or(date_diff('day', DATE '2024-01-04', CAST(ts AS DATE)) >= 8 * (user_id % 3)) AND bool_or(date_diff('day', DATE '2024-01-04', CAST(ts AS DATE)) < 8 * (user_id % 3))")
def version_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third of the users changes to version 2 eight days after the one before."""
    e = load(spark, sf_dir, "events")
    version = F.when(F.datediff(F.to_date("ts"), F.lit("2024-01-04").cast("date")) >= 8 * (F.col("user_id") % 3), 2).otherwise(1)
    return Q.single_version(e.select(F.to_date(F.date_trunc("week", "ts")).alias("week_start"), version.alias("version")), ["version"])


@query(f"WITH {_COUNTS} SELECT week_start, members, entered, exited, before, {r6('(entered + exited) / nullif(before, 0)::DOUBLE', 'turnover')} FROM sb WHERE (entered + exited) / nullif(before, 0)::DOUBLE > 0.1")
def turnover_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Q.turnover(state(spark, sf_dir)))


@query(f"WITH {STATE} SELECT key, week_start FROM us WHERE member AND key % 5 = 0")
def excluded_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = state(spark, sf_dir)
    return Q.excluded_present(s, s.where("key % 5 = 0").select("key").distinct()).select("key", "week_start")


@query(f"WITH {WEEKLY} SELECT week_start, count(CASE WHEN trailing_bars >= 30 THEN 1 END) AS pool FROM um GROUP BY week_start HAVING count(CASE WHEN trailing_bars >= 30 THEN 1 END) < 145")
def pool_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.pool_floor(U.weekly_metrics(universe_bars(spark, sf_dir)), 145, 30)


@query(f"WITH {HOURLY}, c AS (SELECT ts, count(*) AS rows FROM bars GROUP BY ts) SELECT ts, rows, CAST(5 AS BIGINT) AS low, CAST(5 AS BIGINT) AS high FROM c WHERE rows <> 5")
def count_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.count_consistent(hourly(spark, sf_dir).withColumn("stated", F.lit(5).cast("bigint")), "stated")


@query(f"WITH {HOURLY}, x AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM bars), c AS (SELECT ts, count(*) AS present FROM bars WHERE key <> 'view' GROUP BY ts) SELECT x.ts, CAST(4 AS INT) AS expected, coalesce(present, 0) AS present FROM x LEFT JOIN c USING (ts) WHERE coalesce(present, 0) < 0.9 * 4")
def incomplete_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = hourly(spark, sf_dir)
    hours = b.agg(F.min("ts").alias("a"), F.max("ts").alias("b")).select(F.explode(F.expr("sequence(a, b, interval 1 hour)")).alias("ts")).withColumn("expected", F.lit(4))
    return Q.complete_hours(b.where("key <> 'view'"), hours)


@query(f"WITH {STATE} SELECT e.event_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM us WHERE us.member AND us.key = e.user_id AND us.week_start = CAST(date_trunc('week', e.ts) AS DATE))")
def non_member_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("key"), F.col("ts").cast("timestamp").alias("ts"))
    return Q.only_members(e, state(spark, sf_dir)).select("event_id")


@query("WITH l AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1) SELECT user_id AS key, event_id, value FROM l WHERE value > 50 AND user_id % 4 <> 0")
def review_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").withColumnRenamed("user_id", "key")
    return Q.review_candidates(e, F.col("value") > 50, known=e.where("key % 4 = 0").select("key").distinct()).select("key", "event_id", "value")


@query(f"""WITH {STATS}, c AS (SELECT count(*) AS n, count(CASE WHEN NOT (cumret_24 > -1) THEN 1 END) AS a, count(CASE WHEN NOT (dist_high_168 <= 0) THEN 1 END) AS b, count(CASE WHEN NOT (rv_24 < 5) THEN 1 END) AS c, count(CASE WHEN ret IS NOT NULL AND abs(price - before * (1 + ret)) >= 1e-6 THEN 1 END) AS d FROM f)
SELECT 'cumret_above_minus_one' AS check_name, a AS failing_rows, n AS checked_rows FROM c UNION ALL SELECT 'drawdown_not_positive', b, n FROM c UNION ALL SELECT 'volatility_bound', c, n FROM c UNION ALL SELECT 'return_identity', d, n FROM c""")
def validation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features(spark, sf_dir).withColumn("before", F.lag("price").over(R.S.ordered))
    return Q.report(df, {
        "cumret_above_minus_one": F.col("cumret_24") > -1, "drawdown_not_positive": F.col("dist_high_168") <= 0, "volatility_bound": F.col("rv_24") < 5,
        "return_identity": F.abs(F.col("price") - F.col("before") * (1 + F.col("ret"))) < 1e-6,
    })


@query(f"""WITH {STATS}, k AS (SELECT ts, percent_rank() OVER (PARTITION BY ts ORDER BY cumret_24) AS a, percent_rank() OVER (PARTITION BY ts ORDER BY dollar_volume) AS b FROM f)
SELECT ts, {r6('CASE WHEN stddev_pop(a) * stddev_pop(b) > 1e-15 THEN covar_pop(a, b) / (stddev_pop(a) * stddev_pop(b)) END', 'rank_corr')}, count(*) AS n FROM k GROUP BY ts""")
def rank_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(Q.rank_correlation(features(spark, sf_dir), "cumret_24", "dollar_volume"))


@query(f"WITH {STATS} SELECT ts, count(DISTINCT cumret_24) AS cumret_24 FROM f GROUP BY ts HAVING count(DISTINCT cumret_24) > 1")
def varying_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.varies_within_time(features(spark, sf_dir), ["cumret_24"])


# Streaming forms, applied to a batch: the same plans run on readStream (see the tests).
@query(f"WITH {HOURLY} SELECT key, ts, {', '.join(r6(c, c) for c in ('open', 'high', 'low', 'close', 'volume'))} FROM bars")
def tumbling_window_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    return rounded(B.tumbling_bars(t, tie=["event_id"]))


@query(f"""WITH {TICKS}, e AS (SELECT key, price, unnest(generate_series(date_trunc('hour', ts) + INTERVAL 1 HOUR, date_trunc('hour', ts) + INTERVAL 6 HOUR, INTERVAL 1 HOUR)) AS ts FROM ticks)
SELECT key, ts, {r6('sum(price)', 'total')}, {r6('avg(price)', 'mean')}, count(*) AS n FROM e GROUP BY key, ts""")
def sliding_window_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    return rounded(B.sliding_sums(t, "6 hours"))


@query("""WITH g AS (SELECT user_id AS key, ts, CASE WHEN lag(ts) OVER o IS NULL OR ts - lag(ts) OVER o >= INTERVAL 2 HOUR THEN 1 ELSE 0 END AS st FROM events WINDOW o AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(st) OVER (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING) AS i FROM g) SELECT key, min(ts) AS session_start, max(ts) + INTERVAL 2 HOUR AS session_end, count(*) AS n FROM s GROUP BY key, i""")
def gap_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events").select(F.col("user_id").alias("key"), F.col("ts").cast("timestamp").alias("ts"))
    return B.activity_sessions(e)
