"""Helpers shared by the training-data operators."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; null becomes the empty string."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def is_held_out(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4 is 2; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where body uses it inside another lambda."""
    return F.transform(F.array(value), body)[0]


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where it is unset, a folder of our own in local mode; an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or _own_dir()).rstrip("/")


@functools.cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="barloom-")


def persisted(df: DataFrame) -> DataFrame:
    """Writes df as a table in the shared folder and reads it back, so that lineage is cut by files that outlive executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/barloom-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def superseded(*tables: DataFrame) -> None:
    """Deletes tables that persisted() wrote, once nothing reads them any more."""
    for df in tables:
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            found = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            found.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(found, True)


#: A key with more than this share of all rows is joined by broadcast; there are fewer than 1 / HOT_SHARE of them.
HOT_SHARE = 0.001


def join_counted(rows: DataFrame, counted: DataFrame, on: Callable[[DataFrame], Column], total: int) -> DataFrame:
    """Inner join of rows with counted, whose column n says how many of the total rows each of its rows meets; on gives the condition.

    What meets a great share of all rows goes by broadcast, the rest by a merge join in which no task has many rows of one key.
    """
    is_hot = F.col("n") > HOT_SHARE * total
    hot, rest = F.broadcast(counted.where(is_hot).drop("n")), counted.where(~is_hot).drop("n").hint("merge")
    return rows.join(hot, on(hot)).unionByName(rows.join(hot, on(hot), "left_anti").join(rest, on(rest)))


def whole_row(df: DataFrame) -> Column:
    """All columns of df as one struct, so that nothing done to it can meet their names; "row.*" of it gives them back."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
