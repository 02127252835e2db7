"""Registered queries of the training-data operators: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import oracles
from barloom.llm.alignment import alignment
from barloom.llm.common import is_held_out, table
from barloom.llm.decontamination import contamination, is_contaminated
from barloom.llm.exact_dedup import exact_dedup
from barloom.llm.html_text import extract_text
from barloom.llm.langid import fit_language, predict_language
from barloom.llm.line_dedup import line_dedup
from barloom.llm.mixing import mixture
from barloom.llm.near_dedup import near_duplicates
from barloom.llm.quality import fit_quality, quality_scores
from barloom.llm.secrets import secret_spans, span_text
from barloom.llm.sharding import shard_rows
from barloom.llm.suffix_dedup import suffix_dedup
from barloom.llm.whitening import whitened_components


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    base = F.filter("spans", lambda x: x["kind"] != "random")
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"), of("random"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"), may_learn=~is_held_out(F.col("id")))
    return quality_scores(docs, model).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights half way from natural to uniform entropy, no source repeated more than four times, and as many tokens drawn as there are."""
    return mixture(table(spark, sf_dir, "documents"), least_entropy=None, toward_uniform=0.5, most_repeats=4.0, budget_share=1.0).drop("row_hash")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"),
    )


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_language(docs, may_learn=~is_held_out(F.col("id")))
    return predict_language(docs, model).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned text as a digest and its length, with every removed span of the original as start:stop."""
    found = line_dedup(table(spark, sf_dir, "documents"), unit="passage", whole_lines=True)
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["stop"])), ",")
    return found.select("doc_id", F.size("removed").cast("bigint").alias("n_removed"), "n_removed_words", spans.alias("removed"), F.length("text").cast("bigint").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays as a digest, and how much goes."""
    found = suffix_dedup(table(spark, sf_dir, "documents"), length=100)
    n_removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["stop"] - s["start"])
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["stop"])), ",")
    return found.select("doc_id", (F.length("kept") + n_removed).alias("n_bytes"), n_removed.alias("n_removed"), F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), spans.alias("removed"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator's deviation is a decimal of 38 digits; one that no long holds is an error here."""
    return whitened_components(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("bigint"))


OPERATORS = (op1_exact_dedup, op2_secret_scan, op3_quality, op4_mixing, op5_decontamination, op6_sharding, op7_language, op8_near_dedup, op9_html_text, op10_line_dedup, op11_suffix_dedup, op12_alignment, op13_whitening)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": oracles.EXACT_DEDUP, "op5_decontamination": oracles.DECONTAMINATION, "op8_near_dedup": oracles.NEAR_DEDUP, "op11_suffix_dedup": oracles.SUFFIX_DEDUP}
