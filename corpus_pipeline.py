"""A corpus pipeline over the documents table: quality, near-dedup, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's docs. All but
the last return the columns of documents, extra ones and oddly named ones included: rows travel as one struct wherever a stage adds columns of its own.
Empty tables give empty results in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import common, decontamination, mixing, near_dedup, quality, sharding

#: Documents that score lower than this are rejected.
LEAST_QUALITY = 0.7


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, learned from the labels of those that aren't held out.

    Null and empty texts share one score and so one fate; rows with a null doc_id are scored, but not learned from. Repeated rows are all kept or all rejected.
    Without usable labels every score is 0.5 and all documents are rejected.
    """
    model = quality.fit_quality(docs, common.table(spark, sf_dir, "labels"), may_learn=~common.is_held_out(F.col("id")))
    return quality.accepted(docs, model, LEAST_QUALITY)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest identifier.

    Null, empty and wordless texts and rows with a null doc_id have no duplicates and stay. Rows that repeat an identifier are one document: all of them stay or go.
    """
    dropped = near_dedup.near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    rows = docs.select(common.whole_row(docs).alias("row"), F.col("doc_id").alias("id"))
    return rows.join(dropped, F.col("id") == F.col("doc_id"), "left_anti").select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark; null, empty and wordless texts are clean, repeated rows share their fate."""
    return decontamination.clean_documents(docs, common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks for, and at least once.

    A null source is a source of its own; null and empty texts have no tokens and are drawn once for each pass over their source. Repeated rows are drawn alike.
    """
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row, equal texts together; null texts count as empty, repeated rows get slots of their own, other columns are ignored."""
    return sharding.shard_rows(docs)


STAGES = [("quality", keep_quality), ("near_dedup", drop_near_duplicates), ("decontamination", drop_contaminated), ("mixing", mix_sources), ("sharding", shard)]

#: The classifier's trees can't be stated in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.persisted(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
