"""Weekly universe membership: trailing metrics, ranks, dated exclusions and the carry-forward state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.joins import weeks_served
from barloom.operators.rolling import S, Series


@dataclass(frozen=True)
class Rules:
    """Entry and exit rules. Defaults are those of a live universe; tests scale them down."""

    least_bars: int = 500
    entry_cap: float = 20_000_000.0
    exit_cap: float = 5_000_000.0
    entry_rank: int = 120
    exit_rank: int = 250
    cap_weeks: int = 2
    volume_weeks: int = 4


def weekly_metrics(bars: DataFrame, days: int = 30, s: Series = S, cap: str = "mktcap", volume: str = "dollar_volume", exact: bool = True, with_evidence: bool = False) -> DataFrame:
    """(key, week_start): bars, median cap and dollar volume, longest gap in hours of the `days` strictly before each Monday; with_evidence adds them as JSON.

    A bar is copied to the weeks that it serves, four or five, and grouped; no range is joined.
    """
    middle = (lambda c: F.percentile(c, 0.5)) if exact else (lambda c: F.percentile_approx(c, 0.5, 10_000))
    gap = (F.unix_seconds(s.ts) - F.unix_seconds(F.lag(s.ts).over(s.ordered))) / 3600
    served = weeks_served(bars.withColumn("_gap", gap), s.ts, days)
    found = served.groupBy(s.key, "week_start").agg(F.count("*").alias("trailing_bars"), middle(cap).alias("median_cap"), middle(volume).alias("median_volume"), F.max("_gap").alias("longest_gap_hours"))
    if with_evidence:
        found = found.withColumn("evidence", F.to_json(F.struct("trailing_bars", "median_cap", "median_volume", "longest_gap_hours")))
    return found


def weekly_rank(metrics: DataFrame, rules: Rules = Rules(), key: str = "key") -> DataFrame:
    """volume_rank among keys with enough bars of the week, ties by key; null for the others."""
    able = (F.col("trailing_bars") >= rules.least_bars) & F.col("median_volume").isNotNull()
    w = Window.partitionBy("week_start").orderBy(F.when(able, F.col("median_volume")).desc_nulls_last(), key)
    return metrics.withColumn("volume_rank", F.when(able, F.rank().over(w)))


def without_excluded(rows: DataFrame, exclusions: DataFrame, key: str = "key", week: str = "week_start") -> DataFrame:
    """Rows of keys that no exclusion (key, effective_from, null: always) covers in their week."""
    dated = exclusions.groupBy(key).agg(F.min(F.coalesce("effective_from", F.lit("0001-01-01").cast("date"))).alias("_from"))
    return rows.join(dated, key, "left").where(F.col("_from").isNull() | (F.col(week) < F.col("_from"))).drop("_from")


def weekly_inputs(metrics: DataFrame, rules: Rules = Rules(), key: str = "key", first_seen: DataFrame | None = None) -> DataFrame:
    """Every key in every week from its first on (weeks without metrics included) with its exit and entry conditions."""
    weeks = metrics.select("week_start").distinct()
    first = (first_seen or metrics.groupBy(key).agg(F.min("week_start").alias("first_week"))).select(key, "first_week")
    grid = first.crossJoin(F.broadcast(weeks)).where(F.col("week_start") >= F.col("first_week"))  # weeks: a few hundred rows
    rows = grid.join(weekly_rank(metrics, rules, key), [key, "week_start"], "left")
    enters = (F.col("trailing_bars") >= rules.least_bars) & (F.col("median_cap") >= rules.entry_cap) & (F.col("volume_rank") <= rules.entry_rank)
    return rows.select(
        key, "week_start", F.coalesce("trailing_bars", F.lit(0)).alias("trailing_bars"), "median_cap", "median_volume", "volume_rank",
        F.coalesce(F.col("median_cap") < rules.exit_cap, F.lit(True)).alias("low_cap"), F.coalesce(F.col("volume_rank") > rules.exit_rank, F.lit(True)).alias("bad_volume"), F.coalesce(enters, F.lit(False)).alias("meets_entry"),
    )


def membership_state(inputs: DataFrame, seed: DataFrame | None = None, rules: Rules = Rules(), key: str = "key") -> DataFrame:
    """Carries membership forward week by week: a member leaves after cap_weeks low weeks or volume_weeks bad ones in a row, others join when they meet the entry rule.

    One grouping per key and one fold over its weeks (hundreds of rows). seed has (key, low_cap_streak, bad_volume_streak, member); keys
    that it lacks start outside. Adds low_cap_streak, bad_volume_streak, member, entered and exited.
    """
    columns = [c for c in inputs.columns if c != key]
    weeks = inputs.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("week_start", *[c for c in columns if c != "week_start"]))).alias("_weeks"))
    weeks = weeks.join(seed.select(key, F.col("low_cap_streak").cast("bigint").alias("_lc"), F.col("bad_volume_streak").cast("bigint").alias("_bv"), F.col("member").alias("_m")), key, "left") if seed is not None else weeks.withColumns({"_lc": F.lit(0).cast("bigint"), "_bv": F.lit(0).cast("bigint"), "_m": F.lit(False)})
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    step_type = "array<struct<low_cap_streak:bigint,bad_volume_streak:bigint,member:boolean,entered:boolean,exited:boolean>>"
    start = F.struct(number("_lc").alias("lc"), number("_bv").alias("bv"), F.coalesce("_m", F.lit(False)).alias("m"), F.array().cast(step_type).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        lc = F.when(x["low_cap"], acc["lc"] + 1).otherwise(F.lit(0).cast("bigint"))
        bv = F.when(x["bad_volume"], acc["bv"] + 1).otherwise(F.lit(0).cast("bigint"))
        m = F.when(acc["m"], ~((x["low_cap"] & (lc >= rules.cap_weeks)) | (x["bad_volume"] & (bv >= rules.volume_weeks)))).otherwise(x["meets_entry"])
        row = F.struct(lc.alias("low_cap_streak"), bv.alias("bad_volume_streak"), m.alias("member"), (m & ~acc["m"]).alias("entered"), (acc["m"] & ~m).alias("exited"))
        return F.struct(lc.alias("lc"), bv.alias("bv"), m.alias("m"), F.concat(acc["out"], F.array(row)).alias("out"))

    states = weeks.withColumn("_states", F.aggregate("_weeks", start, step, lambda acc: acc["out"]))
    return states.select(key, F.explode(F.arrays_zip("_weeks", "_states")).alias("_x")).select(key, "_x._weeks.*", "_x._states.*")


def membership(version: str, bars: DataFrame, **options) -> DataFrame:
    """Membership by rule version: v1 with the rules above, v2 with a caller's Rules; other names are an error."""
    if version not in ("v1", "v2"):
        raise ValueError(f"unknown membership version {version!r}")
    rules = options.pop("rules", None)
    if version == "v2" and rules is None:
        raise ValueError("v2 needs rules")
    rules = rules or Rules()
    out = membership_state(weekly_inputs(weekly_metrics(bars, **options), rules), rules=rules)
    return out.withColumn("rule_version", F.lit(version))
