"""Feature blocks that are stored for joins: bucketed and sorted by the join keys, so that a star of them needs neither exchange nor sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

#: Sorted bucket files count as sorted scans only with this setting; store_block() writes one file a bucket.
ORDERED_SCANS = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def store_block(df: DataFrame, name: str, keys: Sequence[str] = ("key", "ts"), buckets: int = 64) -> None:
    """Replaces the table `name` by df, dealt to buckets by the hash of all keys and sorted by them: one exchange now, none when blocks with equal buckets are joined.

    Buckets should be about as many as an input of the joined width needs tasks; all blocks of a star need the same number.
    """
    df.repartition(buckets, *keys).sortWithinPartitions(*keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def star_of_blocks(spark: SparkSession, base: str, blocks: Sequence[str], keys: Sequence[str] = ("key", "ts")) -> DataFrame:
    """Left joins of stored blocks to the rows of base on all keys, as merges of their sorted buckets. Columns of blocks must have names of their own."""
    spark.conf.set(ORDERED_SCANS, "true")
    out = spark.table(base)
    for name in blocks:
        out = out.join(spark.table(name).hint("merge"), list(keys), "left")
    return out
