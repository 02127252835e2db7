"""Sharding by minimax contiguous partition, in DataFrame functions only.

Rows with equal texts form an atomic group. Groups are ordered by a hash of the text, but very large ones come first, and gathered into at most SLICES
slices of that order; a group as large as an average slice is an atom of its own, every other slice is one. The atoms
(at most twice SLICES, whatever the input) are one ordered array, and every shard is a contiguous part of it. Atoms above the fair share are
a shard each, in their place; the smallest feasible capacity of the others is found by binary search, each step a greedy check of the array, and
the cuts are made at that capacity.

Slots are ranks within small bins of an atom plus the rows of all bins before, so no shard and no group of copies is
ever sorted in one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import let, persisted

#: Slices of the hash order; the array of atoms has at most twice as many.
SLICES = 1 << 15
#: Rows that a bin holds on average at most.
BIN_ROWS = 20_000


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text plus 1; null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1


def minimax_cuts(atoms: DataFrame, shards: int) -> DataFrame:
    """Shard of every atom: (position, rows, shard) from (position, size, rows), whose order is that of position; shards are contiguous.

    atoms has a bounded number of rows. Everything below is one array and folds over it.
    """
    longs = F.array().cast("array<bigint>")
    number = lambda x: F.lit(x).cast("bigint")
    fields = lambda **c: F.struct(*[v.alias(k) for k, v in c.items()])

    def alone(listed: Column, total: Column) -> Column:
        """Positions of atoms larger than the fair share of what is left, taken from the largest: each is a shard of its own. There are so few that the parts between them fit in the other shards."""
        largest = F.slice(F.array_sort(F.transform(listed, lambda a: fields(less=-a["size"], position=a["position"]))), 1, max(1, (shards - 1) // 2))

        def take(s: Column, t: Column) -> Column:
            fits = s["open"] & (-t["less"] * s["shards"] > s["left"]) & (s["shards"] > 2)
            return F.when(fits, fields(left=s["left"] + t["less"], shards=s["shards"] - 1, open=F.lit(True), found=F.concat(s["found"], F.array(t["position"])))).otherwise(
                fields(left=s["left"], shards=s["shards"], open=F.lit(False), found=s["found"])
            )

        return F.aggregate(largest, fields(left=total, shards=number(shards), open=F.lit(True), found=longs), take, lambda s: s["found"])

    def greedy(marked: Column, capacity: Column, start: Column, opened: Callable[[Column, Column], Column]) -> Column:
        """Fills shards in order; a lone atom opens a shard, and so does the atom after it."""
        def add(g: Column, a: Column) -> Column:
            opens = a["alone"] | g["closed"] | (g["fill"] + a["size"] > capacity)
            return fields(fill=F.when(opens, a["size"]).otherwise(g["fill"] + a["size"]), closed=a["alone"], out=F.when(opens, opened(g["out"], a)).otherwise(g["out"]))

        return F.aggregate(marked, fields(fill=number(0), closed=F.lit(True), out=start), add, lambda g: g["out"])

    def smallest(marked: Column) -> Column:
        """Binary search: the result always suffices, one less never does."""
        def halve(s: Column, _: Column) -> Column:
            mid = F.floor((s["low"] + s["high"]) / 2).cast("bigint")
            needed = lambda m: greedy(marked, m, number(0), lambda n, a: n + 1)
            tried = let(mid, lambda m: F.when(needed(m) <= shards, fields(low=s["low"], high=m)).otherwise(fields(low=m + 1, high=s["high"])))
            return F.when(s["low"] >= s["high"], s).otherwise(tried)

        rest = F.transform(F.filter(marked, lambda a: ~a["alone"]), lambda a: a["size"])
        start = let(rest, lambda r: fields(low=F.coalesce(F.array_max(r), number(0)), high=F.aggregate(r, number(0), lambda t, x: t + x)))
        return let(start, lambda s: F.aggregate(F.sequence(F.lit(1), F.lit(62)), s, halve, lambda s: s["high"]))

    def placed(marked: Column) -> Column:
        starts = let(smallest(marked), lambda c: greedy(marked, c, longs, lambda found, a: F.concat(found, F.array(a["position"]))))
        return let(starts, lambda opened: F.transform(marked, lambda a: fields(position=a["position"], rows=a["rows"], shard=(F.size(F.filter(opened, lambda p: p <= a["position"])) - 1).cast("int"))))

    def cut(s: Column) -> Column:
        marked = F.transform(s["listed"], lambda a: fields(position=a["position"], size=a["size"], rows=a["rows"], alone=F.array_contains(s["own"], a["position"])))
        return let(marked, placed)

    one = atoms.agg(F.array_sort(F.collect_list(F.struct("position", "size", "rows"))).alias("listed"), F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("total"))
    return one.select(F.explode(let(fields(listed=F.col("listed"), own=alone(F.col("listed"), F.col("total"))), cut)).alias("a")).select("a.*")


def shard_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shards: int = 16, slices: int = SLICES) -> DataFrame:
    """(id_col, size, text_crc32, law, shard, slot, grown_shard) for every row; law is "bytes", grown_shard null.

    size is the UTF-8 bytes of the text plus 1. Equal texts share a shard; null counts as the empty text (size 1, crc 0). Slots
    count from 0 in every shard without gaps, in order of atom, bin, text hash and identifier (nulls first); equal rows
    are told apart arbitrarily. There may be empty shards where rows are few or one group is large. An empty table gives an empty
    result. Only the named columns are read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text_bytes(F.col(text_col)).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"))
    rows = persisted(rows)  # narrow, read three times below
    slice_of = F.pmod("h", F.lit(slices))
    groups = rows.groupBy("h").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    # A group of at least an average slice stands alone; there are at most `slices` of those.
    total = groups.agg(F.sum("size").alias("total"))
    large = groups.crossJoin(F.broadcast(total)).where(F.col("size") * slices > F.col("total")).select("h", "size", "rows")
    small = groups.groupBy(slice_of.alias("slice")).agg(F.sum("size").alias("size"), F.sum("rows").alias("rows"))
    taken = large.groupBy(slice_of.alias("slice")).agg(F.sum("size").alias("less"), F.sum("rows").alias("fewer"))
    rest = small.join(taken, "slice", "left").select("slice", (F.col("size") - F.coalesce("less", F.lit(0))).alias("size"), (F.col("rows") - F.coalesce("fewer", F.lit(0))).alias("rows")).where(F.col("rows") > 0)
    atoms = rest.select("slice", F.lit(None).cast("bigint").alias("own"), "size", "rows").unionByName(large.select(slice_of.alias("slice"), F.col("h").alias("own"), "size", "rows"))
    # Groups of the order of a fair share come first, largest first, so that a lone one leaves no small remainder on either side.
    atoms = atoms.crossJoin(F.broadcast(total)).withColumn("first", F.when(F.col("own").isNotNull() & (4 * shards * F.col("size") > F.col("total")), F.col("size"))).drop("total")
    order = Window.orderBy(F.col("first").desc_nulls_last(), "slice", F.col("own").asc_nulls_first())
    numbered = atoms.withColumn("position", F.row_number().over(order).cast("bigint"))
    placed = persisted(minimax_cuts(numbered, shards).join(F.broadcast(numbered.select("position", "slice", "own")), "position"))
    # Both broadcasts have at most twice `slices` rows.
    singles = F.broadcast(placed.where(F.col("own").isNotNull()).select(F.col("own").alias("h"), "own"))
    bins = F.greatest(F.lit(1), F.ceil(F.col("rows") / BIN_ROWS)).cast("bigint")
    atom = F.broadcast(placed.select("position", "shard", bins.alias("bins"), F.coalesce("own", F.lit(0)).alias("own_key"), F.col("own").isNotNull().alias("is_own"), F.col("slice").alias("atom_slice")))
    tagged = rows.join(singles, "h", "left").withColumns({"is_own": F.col("own").isNotNull(), "own_key": F.coalesce("own", F.lit(0)), "atom_slice": slice_of})
    tagged = tagged.join(atom, ["atom_slice", "is_own", "own_key"])
    tagged = tagged.select("id", "size", "text_crc32", "h", "shard", "position", F.pmod(F.xxhash64("id", "h"), "bins").alias("bin"))
    counts = tagged.groupBy("shard", "position", "bin").count()
    before = Window.partitionBy("shard").orderBy("position", "bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("position", "bin", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("position", "bin").orderBy("h", F.col("id").asc_nulls_first()))
    slotted = tagged.withColumn("rank", rank).join(offsets, ["position", "bin"])
    return slotted.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("rank") - 1).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
