"""Operator inputs from the driver tables, and their SQL twins for the oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.operators import bars as B


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, ts, price, volume, event_id): one series per event type."""
    e = load(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("key"), "ts", F.col("value").alias("price"), (F.col("event_id") % 10 + 1).cast("double").alias("volume"), "event_id")


def user_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with one sparse series per user."""
    e = load(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("key"), "ts", F.col("value").alias("price"), (F.col("event_id") % 10 + 1).cast("double").alias("volume"), "event_id")


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.resample_bars(ticks(spark, sf_dir), "hour", tie=["event_id"])


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, ts, price, volume) on every hour."""
    return B.fill_grid(hourly(spark, sf_dir).withColumnRenamed("close", "price"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of unit prices per supplier: a long series."""
    li = load(spark, sf_dir, "lineitem")
    t = li.select(F.col("l_suppkey").alias("key"), F.col("l_shipdate").alias("ts"), (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").alias("volume"), "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice")
    return B.resample_bars(t, "day", tie=["l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "volume"])


#: Bars of one shape for each remainder of the key by 12, as SQL over the close x = close / 1500 and the number i of the bar, for patterns that plain prices don't show:
#: (open, high, low, close, volume). The last has the bars as they are.
SHAPES = (
    ("105 * exp(-i / 100e0)", "105 * exp(-i / 100e0)", "100 * exp(-i / 100e0)", "100 * exp(-i / 100e0)", "volume"),
    ("100 + 10 * x", "101 + 10 * x", "CASE WHEN i % 50 = 0 THEN 1e0 ELSE 99 + 10 * x END", "100 + 10 * x", "volume"),
    ("50e0", "51e0", "50e0", "CASE WHEN i % 10 = 0 THEN 51e0 ELSE 50e0 END", "volume"),
    ("(100 + i % 20 + least(x, 1)) * (CASE WHEN i % 2 = 0 THEN 1.001e0 ELSE 0.999e0 END)", "(100 + i % 20 + least(x, 1)) * 1.02e0", "(100 + i % 20 + least(x, 1)) * 0.98e0", "100 + i % 20 + least(x, 1)", "volume"),
    ("CASE WHEN i = 2 THEN 10e0 ELSE 100e0 END", "100e0", "10e0", "CASE WHEN i = 2 THEN 10e0 ELSE 100e0 END", "volume"),
    ("10 * x", "300e0", "9 * x", "CASE WHEN i % 20 = 0 THEN 300e0 ELSE 10 * x END", "volume"),
    ("(10 + i / 5e0) * 0.99e0", "11 + i / 5e0", "9 + i / 5e0", "10 + i / 5e0", "volume"),
    ("1e0", "1.003e0", "0.999e0", "1 + (i % 3) / 1000e0", "volume"),
    ("50 * x", "65 * x", "35 * x", "50 * x", "CASE WHEN i % 2 = 0 THEN 0e0 ELSE volume END"),
    ("20e0", "20.1e0", "19.9e0", "20 + x / 10", "CASE WHEN i % 100 = 0 THEN 90000e0 ELSE volume END"),
    ("51 * x", "65 * x", "40 * x", "50 * x", "volume"),
    ("open", "high", "low", "close", "volume"),
)


def shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of the suppliers, reshaped by SHAPES."""
    rows = daily(spark, sf_dir).withColumns({"i": F.row_number().over(Window.partitionBy("key").orderBy("ts")), "x": F.col("close") / 1500})
    pick = lambda n: F.expr("CASE " + " ".join(f"WHEN key % 12 = {k} THEN CAST({shape[n]} AS DOUBLE)" for k, shape in enumerate(SHAPES)) + " END")
    return rows.select("key", "ts", *[pick(n).alias(c) for n, c in enumerate(("open", "high", "low", "close", "volume"))])


def daily_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(key, ts, price, volume) of the daily bars: a series for each supplier, more of them at every scale factor."""
    return daily(spark, sf_dir).select("key", "ts", F.col("close").alias("price"), "volume")


# SQL twins. Each is a list of CTEs; they build on each other in this order.
TICKS = "ticks AS (SELECT event_type AS key, ts, value AS price, CAST(event_id % 10 + 1 AS DOUBLE) AS volume, event_id FROM events)"
USER_TICKS = "ticks AS (SELECT user_id AS key, ts, value AS price, CAST(event_id % 10 + 1 AS DOUBLE) AS volume, event_id FROM events)"
HOURLY = TICKS + """,
bars AS (SELECT key, date_trunc('hour', ts) AS ts, first(price ORDER BY ts, event_id) AS open, max(price) AS high, min(price) AS low, last(price ORDER BY ts, event_id) AS close, sum(volume) AS volume
  FROM ticks GROUP BY key, date_trunc('hour', ts))"""
GRID = HOURLY + """,
span AS (SELECT key, min(ts) AS a, max(ts) AS b FROM bars GROUP BY key),
hours AS (SELECT key, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS ts FROM span),
grid AS (SELECT h.key, h.ts, last_value(bars.close IGNORE NULLS) OVER (PARTITION BY h.key ORDER BY h.ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price, coalesce(bars.volume, 0.0) AS volume
  FROM hours h LEFT JOIN bars ON bars.key = h.key AND bars.ts = h.ts)"""
RETURNS = GRID + """,
lagged AS (SELECT *, lag(price) OVER (PARTITION BY key ORDER BY ts) AS before FROM grid),
moved AS (SELECT *, price / nullif(before, 0) - 1 AS ret, CASE WHEN price > 0 AND before > 0 THEN ln(price / before) END AS logret FROM lagged),
r AS (SELECT *, lag(ret) OVER (PARTITION BY key ORDER BY ts) AS prev_ret, coalesce(logret, 0) AS lr, coalesce(volume, 0) * coalesce(price, 0) AS dollar_volume FROM moved)"""
DAILY = """days AS (SELECT l_suppkey AS key, date_trunc('day', l_shipdate) AS ts, l_extendedprice / l_quantity AS price, l_quantity AS volume, l_shipdate, l_orderkey, l_partkey, l_linenumber, l_extendedprice FROM lineitem),
daily AS (SELECT key, CAST(ts AS TIMESTAMP) AS ts, first(price ORDER BY l_shipdate, l_orderkey, l_partkey, l_linenumber, l_extendedprice, volume) AS open, max(price) AS high, min(price) AS low,
  last(price ORDER BY l_shipdate, l_orderkey, l_partkey, l_linenumber, l_extendedprice, volume) AS close, sum(volume) AS volume FROM days GROUP BY key, ts)"""

SHAPED = DAILY + """,
numbered AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts) AS i, close / 1500 AS x FROM daily),
bars AS (SELECT key, ts, """ + ", ".join("CASE " + " ".join(f"WHEN key % 12 = {k} THEN CAST({shape[n]} AS DOUBLE)" for k, shape in enumerate(SHAPES)) + f" END AS {c}" for n, c in enumerate(("open", "high", "low", "close", "volume"))) + " FROM numbered)"
DAILY_RETURNS = DAILY + ",\ngrid AS (SELECT key, ts, close AS price, volume FROM daily)" + RETURNS.removeprefix(GRID)


def w(name: str, n: int, key: str = "key", ts: str = "ts") -> str:
    """Named window of the last n rows."""
    return f"{name} AS (PARTITION BY {key} ORDER BY {ts} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def prior(name: str, n: int) -> str:
    return f"{name} AS (PARTITION BY key ORDER BY ts ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def hours(name: str, n: int) -> str:
    """Named inclusive time window of n hours."""
    return f"{name} AS (PARTITION BY key ORDER BY ts RANGE BETWEEN INTERVAL {n} HOUR PRECEDING AND CURRENT ROW)"


def r6(expression: str, name: str) -> str:
    return f"round(CAST({expression} AS DOUBLE) + 2.3e-8, 6) + CAST(0 AS DOUBLE) AS {name}"
