"""Reading, flattening and writing tables, and incremental loads on Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.expr import normalize_epoch

#: Contract of open/high/low/close/volume bars as raw payloads carry them.
PAYLOAD = "chain string, data struct<items: array<struct<address: string, unixTime: bigint, o: double, h: double, l: double, c: double, v: double>>>"
MANUAL_EXCLUSIONS = "chain string, key string, tag string, notes string"


def read_seed(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A CSV seed with a header, under an explicit schema."""
    return spark.read.csv(path, schema=schema, header=True, sep=sep)


def read_table(spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A Parquet, ORC or JSON table, under a schema where the format has none of its own."""
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def flatten_items(df: DataFrame, path: str, mapping: Mapping[str, str | Column], keep: Sequence[str] = (), valid: Column | None = None) -> DataFrame:
    """One row per element of a nested array. mapping names output columns by expressions over the element `item`; rows that aren't valid go."""
    items = df.select(*keep, F.explode(path).alias("item"))
    out = items.select(*keep, *[(F.expr(x) if isinstance(x, str) else x).alias(name) for name, x in mapping.items()])
    return out if valid is None else out.where(valid)


#: Bars of a payload: try_cast keeps a bad number from failing the load.
BAR_ITEMS = {"key": "item.address", "ts": "timestamp_seconds(item.unixTime)", "open": "try_cast(item.o AS decimal(38,9))", "high": "try_cast(item.h AS decimal(38,9))", "low": "try_cast(item.l AS decimal(38,9))", "close": "try_cast(item.c AS decimal(38,9))", "volume": "try_cast(item.v AS decimal(38,9))"}


def rename_positional(df: DataFrame, names: Sequence[str], since: Column | None = None) -> DataFrame:
    """Columns by position; with `since`, a condition on the new names."""
    out = df.toDF(*names)
    return out if since is None else out.where(since)


def clean_epoch_prices(df: DataFrame, ts: str = "ts", price: str = "price", distinct: bool = False) -> DataFrame:
    """Epoch numbers of any unit become timestamps; rows without a time or a price go."""
    out = df.withColumn(ts, normalize_epoch(ts)).where(F.col(ts).isNotNull() & F.col(price).isNotNull())
    return out.distinct() if distinct else out


def append_new(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose full key target lacks, one per key."""
    w = Window.partitionBy(*keys).orderBy(*[c for c in incoming.columns if c not in keys] or keys)
    fresh = incoming.join(target.select(*keys), list(keys), "left_anti")
    return fresh.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n").select(incoming.columns)


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None, since: Column | None = None) -> DataFrame:
    """Target with the update columns of incoming rows (all by default) where keys match, and incoming rows with new keys.

    With since, only target rows that meet it are compared; the others stay as they are, and incoming rows with their keys are added. Incoming must have one row per key.
    """
    update = [c for c in (update if update is not None else target.columns) if c not in keys]
    open_rows, shut = (target, None) if since is None else (target.where(since), target.where(~F.coalesce(since, F.lit(False))))
    new = incoming.select(*keys, *[F.col(c).alias(f"_{c}") for c in target.columns if c not in keys], F.lit(True).alias("_new"))
    both = open_rows.withColumn("_old", F.lit(True)).join(new, list(keys), "full")
    value = lambda c: F.when(F.col("_new").isNotNull() & (F.col("_old").isNull() | F.lit(c in update)), F.col(f"_{c}")).otherwise(F.col(c))
    out = both.select(*[F.col(c) if c in keys else value(c).alias(c) for c in target.columns])
    return out if shut is None else shut.unionByName(out)


def after_watermark(incoming: DataFrame, target: DataFrame, key: str = "key", ts: str = "ts") -> DataFrame:
    """Rows later than their key's last row in target, and rows of keys that it lacks."""
    marks = target.groupBy(key).agg(F.max(ts).alias("_mark"))
    return incoming.join(marks, key, "left").where(F.col("_mark").isNull() | (F.col(ts) > F.col("_mark"))).drop("_mark")


def after_global_watermark(incoming: DataFrame, target: DataFrame, ts: str = "ts", overlap: str | None = None) -> DataFrame:
    """Rows later than target's last row, less an overlap interval (then merge with upsert()); all rows if target is empty."""
    mark = target.agg(F.max(ts).alias("_mark"))  # one row
    edge = F.col("_mark") if overlap is None else F.col("_mark") - F.expr(f"INTERVAL {overlap}")
    return incoming.crossJoin(F.broadcast(mark)).where(F.col("_mark").isNull() | (F.col(ts) > edge)).drop("_mark")


def write_partitioned(df: DataFrame, path: str, ts: str = "ts", cluster: Sequence[str] = (), mode: str = "error", protected: bool = True) -> None:
    """Parquet by day, sorted by cluster columns in every file. A protected table is never overwritten.

    mode "overwrite" replaces the days that df has and leaves the others.
    """
    if mode == "overwrite" and protected:
        raise PermissionError("the table is protected: pass protected=False to replace days of it")
    days = df.withColumn("dt", F.to_date(ts)).repartition("dt", *cluster).sortWithinPartitions("dt", *cluster, ts)
    days.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)


def evolve(target_schema: T.StructType, incoming: DataFrame) -> DataFrame:
    """Incoming under the target's columns: missing ones null, new ones appended."""
    known = {f.name: f for f in target_schema.fields}
    out = incoming.withColumns({n: F.lit(None).cast(f.dataType) for n, f in known.items() if n not in incoming.columns})
    return out.select(*known, *[c for c in incoming.columns if c not in known])
