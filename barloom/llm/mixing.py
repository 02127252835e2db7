"""Mixing sources to target weights by temperature.

The natural token share p of every source becomes a weight proportional to p^a. The exponent a is bisected between 0 (all sources alike) and
1 (natural): the largest a whose weights have the target entropy, and the smallest a whose most repeated source stays
under a repetition limit; the larger of the two holds. The bisection runs on sums over the table of source totals, 32 exponents to a pass, so the number of
sources is not bounded.

A budget of tokens is then dealt by weight. Every source is a permutation of hashed blocks, and each block a permutation of its
documents. A source's budget is whole passes over that permutation and a rest: the documents at its start, as far
as the rest goes. Prefix sums run over blocks first and then inside a block, so a source that holds a third of all rows is
never sorted in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import persisted, whole_row

GRID = 32
PASSES = 7
#: Blocks of a source at most, so that the blocks of all but a great many sources fit one window task each.
MOST_BLOCKS = 1 << 15


def token_count(text: Column) -> Column:
    """Runs of anything but white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("bigint")


def _sums(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For every exponent: the sum of p^a and the sum of p^a ln p."""
    # Exponents are rows, not expressions, so that every pass runs the same code; at most 2 x (GRID + 1) rows come back.
    each = shares.select(F.posexplode(F.lit(exponents)).alias("k", "a"), F.ln("share").alias("log"))
    power = F.exp(F.col("a") * F.col("log"))
    found = {r[0]: (r[1], r[2]) for r in each.groupBy("k").agg(F.sum(power), F.sum(power * F.col("log"))).collect()}
    return [found[k] for k in range(len(exponents))]


def solve_exponent(shares: DataFrame, *, least_entropy: float | None = None, toward_uniform: float | None = None, most_repeats: float | None = None, repeats_at: float | None = 1.0) -> float:
    """The exponent for shares (column share > 0, summing to 1).

    least_entropy: fraction of the largest possible entropy (ln of the number of sources) that the weights must have; toward_uniform: fraction of the way from the natural entropy to
    the largest. Each asks for the largest such exponent. most_repeats: largest budget over tokens of any source, the smallest such exponent, with a budget of repeats_at x all
    tokens, or with None the budget at which the source that is repeated least is drawn once. With both, the larger of the exponents, so that the limit holds. No sources: 1.
    """
    n, smallest, largest = shares.agg(F.count("*"), F.min("share"), F.max("share")).first()
    if not n:
        return 1.0
    if toward_uniform is not None:
        ((z, s),) = _sums(shares, [1.0])
        natural = math.log(z) - s / z
        target = (natural + toward_uniform * (math.log(n) - natural)) / math.log(n) if n > 1 else 0.0
        least_entropy = max(target, least_entropy or 0.0)

    def fits_entropy(a: float, z: float, s: float) -> bool:
        return math.log(z) - a * s / z >= least_entropy * math.log(n) - 1e-12

    def fits_repeats(a: float, z: float, s: float) -> bool:
        repeats = (largest / smallest) ** (1 - a) if repeats_at is None else repeats_at * smallest ** (a - 1) / z
        return repeats <= most_repeats + 1e-12

    def narrower(low: float, high: float, good: list[bool], falls: bool) -> tuple[float, float]:
        """Where the fits change: entropy falls with the exponent (fits below a point), repetition too (fits above a point)."""
        at = lambda k: low + (high - low) * k / GRID
        if falls:
            last = max((k for k in range(GRID + 1) if good[k]), default=0)
            return (high, high) if last == GRID else (at(last), at(last + 1))
        first = min((k for k in range(GRID + 1) if good[k]), default=GRID)
        return (low, low) if first == 0 else (at(first - 1), at(first))

    # Both searches go on together, a pass over the totals for each step.
    searches = [(fits, falls) for fits, falls, wanted in ((fits_entropy, True, least_entropy), (fits_repeats, False, most_repeats)) if wanted is not None]
    ends = [(0.0, 1.0)] * len(searches)
    for _ in range(PASSES):
        if all(low == high for low, high in ends):
            break
        grids = [[low + (high - low) * k / GRID for k in range(GRID + 1)] for low, high in ends]
        sums = iter(_sums(shares, [a for grid in grids for a in grid]))
        good = [[fits(a, *next(sums)) for a in grid] for (fits, _), grid in zip(searches, grids)]
        ends = [narrower(low, high, g, falls) if low < high else (low, high) for (_, falls), (low, high), g in zip(searches, ends, good)]
    found = [low if falls else high for (_, falls), (low, high) in zip(searches, ends)]
    return max(found, default=1.0)


def _row_hash(seed: int, id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))


def _key(source: Column) -> Column:
    """The source as a string that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, least_entropy: float | None = 0.97, toward_uniform: float | None = None, most_repeats: float | None = 4.0, budget_tokens: float | None = None, budget_share: float | None = None, block_tokens: int = 200_000, seed: int = 17) -> DataFrame:
    """(id_col, source, n_tokens, weight, block, position, copies, row_hash) for every row.

    weight is that of the source (see solve_exponent for the targets); copies says how often the document is drawn; position is the number of tokens before it in its source's
    permutation. The budget is budget_tokens, or budget_share x all tokens; without either it is the smallest at which every document is drawn at least once
    (sources below their weight are repeated, none is cut). A null source is a source of its own. Rows without tokens
    are drawn once for each pass over their source and at least once. Repeated rows are drawn separately, and ties of hash and
    identifier are broken arbitrarily. With no tokens at all every row has copies 1. An empty table gives an empty result.
    Other columns are ignored.
    """
    rows = persisted(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), _key(F.col(source_col)).alias("key"), token_count(F.col(text_col)).alias("n_tokens"), _row_hash(seed, id_col, text_col).alias("h")))
    totals = rows.groupBy("key").agg(F.sum("n_tokens").alias("tokens"))
    everything = totals.agg(F.sum("tokens")).first()[0] or 0
    shares = persisted(totals.withColumn("share", F.col("tokens") / F.lit(float(max(everything, 1)))))
    positive = shares.where(F.col("tokens") > 0)
    budget = budget_share * everything if budget_tokens is None and budget_share is not None else budget_tokens
    exponent = solve_exponent(positive, least_entropy=least_entropy, toward_uniform=toward_uniform, most_repeats=most_repeats, repeats_at=None if budget is None else budget / max(everything, 1))
    z = positive.agg(F.sum(F.pow("share", F.lit(exponent)))).first()[0] or 1.0
    weighted = shares.withColumn("weight", F.when(F.col("tokens") > 0, F.pow("share", F.lit(exponent)) / z).otherwise(F.lit(0.0)))
    if budget is None:
        budget = weighted.where(F.col("weight") > 0).agg(F.max(F.col("tokens") / F.col("weight"))).first()[0] or 0.0
    # Rounding in the weights must not take a token off a source that is to be drawn whole.
    due = F.floor(F.lit(float(budget)) * F.col("weight") + 0.5).cast("bigint")
    plan = weighted.select(
        "key", "weight", F.least(F.lit(MOST_BLOCKS), F.ceil(F.greatest(F.col("tokens"), F.lit(1)) / block_tokens)).cast("bigint").alias("blocks"),
        F.when(F.col("tokens") > 0, F.floor(due / F.col("tokens"))).otherwise(1).cast("bigint").alias("passes"),
        F.when(F.col("tokens") > 0, due % F.col("tokens")).otherwise(0).cast("bigint").alias("rest"),
    )
    dealt = rows.join(plan, "key").withColumn("block", F.pmod("h", "blocks"))
    blocks = dealt.groupBy("key", "block").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.partitionBy("key").orderBy(F.xxhash64(F.lit(seed), "key", "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("key", "block", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("key", "block").orderBy("h", F.col("id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(offsets, ["key", "block"])
    placed = placed.withColumn("position", F.col("offset") + F.col("inner"))
    # The document in which the rest ends is drawn when at least half of it is due.
    extra = (2 * F.col("position") + F.col("n_tokens") <= 2 * F.col("rest")) & (F.col("rest") > 0) & (F.col("n_tokens") > 0)
    copies = F.col("passes") + F.when(extra, 1).otherwise(0)
    copies = F.when(F.col("n_tokens") == 0, F.greatest(copies, F.lit(1))).otherwise(copies)
    return placed.select(F.col("id").alias(id_col), "source", "n_tokens", "weight", "block", "position", copies.cast("bigint").alias("copies"), F.col("h").alias("row_hash"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *, seed: int = 17, **options) -> DataFrame:
    """The rows of docs, each as often as mixture() draws it, with all their columns, whatever their names.

    Rows of the same identifier, text and source share their largest draw. Null texts and sources, empty texts, ties and empty tables are as in mixture().
    """
    drawn = mixture(docs, id_col, text_col, source_col, seed=seed, **options).where(F.col("copies") > 0)
    drawn = drawn.groupBy("row_hash", _key(F.col("source")).alias("source_key"), F.col(id_col).alias("drawn_id")).agg(F.max("copies").cast("int").alias("copies"))
    rows = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("id"), _row_hash(seed, id_col, text_col).alias("h"), _key(F.col(source_col)).alias("key"))
    met = rows.join(drawn, (F.col("h") == F.col("row_hash")) & (F.col("key") == F.col("source_key")) & F.col("id").eqNullSafe(F.col("drawn_id")))
    return met.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
