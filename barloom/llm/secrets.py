"""Secret scans by patterns and by a randomness test battery, in DataFrame functions only.

Known formats are found by pattern. Other secrets are found by how random they are: every run of 20 or more token
characters outside those, that mixes letters with digits or small letters with capitals, gets an inferred encoding (hex, base32, lower-case base36 or
base64), and three tests of "independent uniform symbols of that alphabet": chi-squared on the counts of symbols and, as short tokens
have few of each, of kinds of symbols (capitals, small letters, digits and signs); a runs test about the middle of the alphabet; and lag-1
serial correlation. Fisher's method joins the three p-values, unless the least of them says more (Bonferroni's).

False discoveries are controlled over the whole corpus, separately in every class of length and
of tokens with and without digits (short tokens give weak tests, so they must not share a cut with long ones): ordinary tokens have small p-values, so the tokens with large ones, where
EVIDENCE of random tokens lie, say how many random ones there are (Storey's estimate). How the battery's p-values of random tokens are distributed is measured on CALIBRATION tokens of each class
that are drawn uniformly. A class reports the tokens below the largest cut at which at most a share q of them is estimated to be ordinary, and that carry enough bits. The tests
measure the share on paths, identifiers, UUIDs and words. Encoded data of high entropy counts as random.

The texts are read once; places and scores go to a narrow table, which never holds a secret itself. The cuts come from a histogram of p-values, so the table that is broadcast has one row for
each class.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import let, persisted

# The patterns of the known formats. Kinds are listed in the order that breaks ties.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_=-]{20,}"

# Alphabets by name.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
#: Where kinds of symbols begin and end in an alphabet.
KINDS_AT = {"hex": (0, 10, 16), "base32": (0, 26, 32), "base36": (0, 10, 36), "base64": (0, 26, 52, 64)}
#: Upper ends of the length classes (characters); longer tokens share the last class.
LENGTH_CLASSES = (24, 32, 48, 64, 128)
#: Matches that are folded into one array at once.
PART = 256
#: Random tokens of each class that are drawn, and the share of random tokens that counts as evidence.
CALIBRATION, EVIDENCE = 1024, 0.8
#: Histogram bins for each unit of -ln p, and the largest -ln p that is told apart.
BINS, MOST = 20, 600


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def found(text: str, pattern: str, group: int = 0) -> Column:
    """array<struct<start, stop, value>> of the leftmost non-overlapping matches; code points, stop exclusive; [] without any.

    Positions are running sums over the pieces that split() leaves and the matches between them, PART matches to an array, so that many matches take time in proportion.
    """
    p = _literal(pattern)
    kind = "array<struct<start:int,stop:int,value:string>>"
    return F.expr(
        f"""CASE WHEN {text} RLIKE {p} THEN aggregate(
            transform(array(arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), regexp_extract_all({text}, {p}, {group}))),
                m -> transform(sequence(0, CAST((size(m) - 1) / {PART} AS int)), g -> slice(m, g * {PART} + 1, {PART})))[0],
            named_struct('at', 0, 'done', CAST(array() AS array<{kind}>)),
            (a, part) -> aggregate(part,
                named_struct('at', a.at, 'done', a.done, 'out', CAST(array() AS {kind})),
                (b, x) -> IF(x['1'] IS NULL, b, named_struct(
                    'at', b.at + length(x['0']) + length(x['1']), 'done', b.done,
                    'out', concat(b.out, array(named_struct('start', b.at + length(x['0']), 'stop', b.at + length(x['0']) + length(x['1']), 'value', x['2']))))),
                b -> named_struct('at', b.at, 'done', concat(b.done, array(b.out)))),
            a -> flatten(a.done))
        ELSE CAST(array() AS {kind}) END"""
    )


def outside(tokens: Column, known: Column) -> Column:
    """The tokens, in order of start, that overlap none of known; each part of PART tokens looks at the known spans near it only."""
    def free(part: Column) -> Column:
        near = F.filter(known, lambda b: (b["start"] < part[F.size(part) - 1]["stop"]) & (b["stop"] > part[0]["start"]))
        return let(near, lambda near: F.filter(part, lambda x: ~F.exists(near, lambda b: (b["start"] < x["stop"]) & (x["start"] < b["stop"]))))

    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(tokens) - 1) / PART).cast("int")), lambda g: F.slice(tokens, g * PART + 1, PART))
    return F.when(F.size(tokens) > 0, F.flatten(F.transform(parts, free))).otherwise(tokens)


def is_candidate(value: Column) -> Column:
    """Letters mixed with digits, or small letters with capitals."""
    return value.rlike("[A-Za-z]") & (value.rlike("[0-9]") | value.rlike("[a-z]") & value.rlike("[A-Z]"))


def inferred_encoding(value: Column) -> Column:
    """Name of the narrowest alphabet that covers the token; null for tokens that are no candidates."""
    body = F.regexp_replace(value, "=+$", "")
    return (
        F.when(~is_candidate(body), F.lit(None))
        .when(body.rlike("^[0-9a-f]+$") | body.rlike("^[0-9A-F]+$"), F.lit("hex"))
        .when(body.rlike("^[A-Z2-7]+$"), F.lit("base32"))
        .when(body.rlike("^[0-9a-z]+$") | body.rlike("^[0-9A-Z]+$"), F.lit("base36"))
        .when(body.rlike("[a-z]") & body.rlike("[A-Z]"), F.lit("base64"))
    )


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, by the rational-times-exponential approximation 7.1.26 of Abramowitz and Stegun."""
    x = F.abs(z) / F.lit(2.0 ** 0.5)
    t = 1 / (1 + 0.3275911 * x)
    tail = 0.5 * t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429)))) * F.exp(-x * x)
    return F.when(z >= 0, tail).otherwise(1 - tail)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _neighbours(values: Column, n: Column, both: Callable[[Column, Column], Column]) -> Column:
    return F.zip_with(F.slice(values, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(values, F.lit(2), F.greatest(n - 1, F.lit(0))), both)


def battery(value: Column) -> Column:
    """struct<encoding, symbols, p_chi2, p_runs, p_serial, log_p, bits> of a token; log_p is -ln of the joined p.

    Tokens without an inferred encoding, or of fewer than two symbols, have null p-values, log_p and bits.
    """
    least = F.lit(1e-200)
    sizes = F.create_map(*[F.lit(x) for name, symbols in ALPHABETS.items() for x in (name, len(symbols))])
    alphabets = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])
    edges = F.create_map(*[x for name, ends in KINDS_AT.items() for x in (F.lit(name), F.array(*[F.struct(F.lit(float(a)).alias("low"), F.lit(float(b)).alias("high")) for a, b in zip(ends, ends[1:])]))])

    def coded(e: Column) -> Column:
        plain = F.regexp_replace(F.translate(value, "-_", "+/"), "=+$", "")
        plain = F.when(e.isin("hex", "base36"), F.lower(plain)).otherwise(plain)
        x = F.filter(F.transform(F.filter(F.split(plain, ""), lambda c: c != ""), lambda c: (F.instr(alphabets[e], c) - 1).cast("double")), lambda k: k >= 0)  # signs of no alphabet, such as = inside, are no symbols
        return F.struct(e.alias("e"), F.coalesce(sizes[e], F.lit(64)).cast("double").alias("size"), x.alias("x"))

    def sums(s: Column) -> Column:
        x, size, count = s["x"], s["size"], F.size(s["x"])
        return F.struct(
            s["e"].alias("e"), size.alias("size"), count.alias("count"), x.alias("x"),
            F.aggregate(F.sequence(F.lit(0), size.cast("int") - 1), F.lit(0.0), lambda a, k: a + F.pow(F.size(F.filter(x, lambda y: y == k)).cast("double"), F.lit(2.0))).alias("squares"),
            F.coalesce(edges[s["e"]], F.array().cast("array<struct<low:double,high:double>>")).alias("kinds"),
            F.size(F.filter(x, lambda y: y >= size / 2)).cast("double").alias("high"),
            F.size(F.filter(_neighbours(x, count, lambda a, b: (a >= size / 2) != (b >= size / 2)), lambda d: d)).cast("double").alias("turns"),
            F.try_divide(_total(x), count.cast("double")).alias("mean"),
        )

    def scores(s: Column) -> Column:
        n, size, high = s["count"].cast("double"), s["size"], s["high"]
        df, low = size - 1, n - high
        z_of = lambda chi2, df: (F.pow(chi2 / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        z_chi2 = z_of(F.greatest(s["squares"] * size / n - n, F.lit(0.0)), df)

        def of_kind(k: Column) -> Column:
            due = n * (k["high"] - k["low"]) / size
            return F.pow(F.size(F.filter(s["x"], lambda y: (y >= k["low"]) & (y < k["high"]))) - due, F.lit(2.0)) / due

        z_kinds = z_of(_total(F.transform(s["kinds"], of_kind)), F.greatest(F.size(s["kinds"]) - 1, F.lit(1)).cast("double"))
        mean_runs = 1 + 2 * high * low / n
        var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
        z_runs = F.when(var_runs > 0, (s["turns"] + 1 - mean_runs) / F.sqrt(var_runs))
        spread = _total(F.transform(s["x"], lambda y: (y - s["mean"]) * (y - s["mean"])))
        lagged = _total(_neighbours(s["x"], s["count"], lambda a, b: (a - s["mean"]) * (b - s["mean"])))
        z_serial = F.try_divide(lagged, spread) * F.sqrt(n) + 1 / F.sqrt(n)
        bounded = lambda p: F.greatest(F.least(F.coalesce(p, least), F.lit(1.0)), least)
        return F.struct(
            bounded(2 * F.least(_upper_tail(z_chi2), _upper_tail(z_kinds))).alias("chi2"), bounded(2 * _upper_tail(F.abs(z_runs))).alias("runs"), bounded(2 * _upper_tail(F.abs(z_serial))).alias("serial"),
            (n * F.log2(size)).alias("bits"),
        )

    def joined(s: Column) -> Column:
        known = s["e"].isNotNull() & (s["count"] >= 2)

        def out(p: Column) -> Column:
            half = -(F.ln(p["chi2"]) + F.ln(p["runs"]) + F.ln(p["serial"]))
            least = F.least(p["chi2"], p["runs"], p["serial"])
            return F.struct(
                s["e"].alias("encoding"), s["count"].alias("symbols"), p["chi2"].alias("p_chi2"), p["runs"].alias("p_runs"), p["serial"].alias("p_serial"),
                # One strong deviation must not be diluted by the other tests: the better of Fisher's and Bonferroni's rule.
                F.greatest(F.greatest(half - F.ln(1 + half + half * half / 2), -F.ln(3 * least)) - F.ln(F.lit(2.0)), F.lit(0.0)).alias("log_p"), p["bits"].alias("bits"),
            )

        nothing = F.lit(None).cast("double")
        empty = F.struct(s["e"].alias("encoding"), s["count"].alias("symbols"), *[nothing.alias(k) for k in ("p_chi2", "p_runs", "p_serial", "log_p", "bits")])
        return F.when(known, let(scores(s), out)).otherwise(empty)

    return let(inferred_encoding(value), lambda e: let(coded(e), lambda c: let(sums(c), joined)))


def token_class(symbols: Column, value: Column) -> Column:
    """Classes of length, and again for tokens without a digit."""
    out = F.lit(len(LENGTH_CLASSES))
    for k, most in reversed(list(enumerate(LENGTH_CLASSES))):
        out = F.when(symbols <= most, F.lit(k)).otherwise(out)
    return out + F.when(value.rlike("[0-9]"), 0).otherwise(len(LENGTH_CLASSES) + 1)


def random_tokens(spark: SparkSession) -> DataFrame:
    """(class, value): CALIBRATION tokens of every class, of independent uniform symbols of base64, without digits in the classes of such tokens."""
    ends = [19, *LENGTH_CLASSES, 2 * LENGTH_CLASSES[-1]]
    n = len(LENGTH_CLASSES) + 1
    number = F.col("id") % n
    low, high = (F.element_at(F.array(*[F.lit(x) for x in xs]), (number + 1).cast("int")) for xs in (ends[:-1], ends[1:]))
    length = low + 1 + F.pmod(F.xxhash64("id"), high - low)
    every = ALPHABETS["base64"]
    letters = "".join(c for c in every if not c.isdigit())
    draw = lambda symbols: F.array_join(F.transform(F.sequence(F.lit(1), length.cast("int")), lambda k: F.substring(F.lit(symbols), (F.pmod(F.xxhash64(F.lit(7), "id", k), F.lit(len(symbols))) + 1).cast("int"), 1)), "")
    plain = F.floor(F.col("id") / n) % 2 == 0
    return spark.range(2 * n * CALIBRATION).select(F.when(plain, number).otherwise(number + n).cast("int").alias("class"), F.when(plain, draw(every)).otherwise(draw(letters)).alias("value"))


def report_cuts(tested: DataFrame, drawn: DataFrame, q: float) -> DataFrame:
    """(class, cut) from (class, log_p) of the tokens and of random ones: below cut at most a share q of a class's tokens is estimated to be ordinary. Classes without such a cut have no row.

    Works on counts by class and bin of log_p: at most (classes) x (BINS * MOST) rows reach the windows.
    """
    binned = lambda df, name: df.select("class", F.floor(F.least(F.col("log_p"), F.lit(float(MOST))) * BINS).cast("int").alias("bin")).groupBy("class", "bin").agg(F.count("*").alias(name))
    counts = binned(tested, "seen").join(binned(drawn, "random"), ["class", "bin"], "full")
    by_class = Window.partitionBy("class")
    up = by_class.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.withColumns({"seen": F.coalesce(F.sum("seen").over(up), F.lit(0)), "random": F.coalesce(F.sum("random").over(up), F.lit(0)), "all": F.coalesce(F.sum("random").over(by_class), F.lit(0))})
    is_evidence = F.col("random") <= EVIDENCE * F.col("all")
    rows = rows.withColumns({"evidence": F.max(F.when(is_evidence, F.col("seen"))).over(by_class), "weight": F.max(F.when(is_evidence, F.col("random"))).over(by_class)})
    estimate = F.try_divide(F.col("evidence") * F.col("random"), F.col("weight"))
    passed = rows.where((F.col("seen") > 0) & (estimate >= (1 - q) * F.col("seen")))
    return passed.groupBy("class").agg(((F.max("bin") + 1) / F.lit(float(BINS))).alias("cut"))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, q: float = 0.05, least_bits: float = 96.0) -> DataFrame:
    """(id_col, spans array<struct<kind, start, stop>>) for every row, in order of start, then of KINDS; code points, stop exclusive.

    Pattern spans always stay; random spans are added where they overlap none of them. Null text counts as
    empty and has no spans. Repeated rows and null identifiers get their own result row. An empty table gives an empty result;
    other columns are ignored. A text of any length is scanned whole.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))

    def tagged(name: str, spans: Column) -> Column:
        return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(name)).alias("k"), x["stop"].alias("stop")))

    known = base.select(
        "id",
        F.concat(tagged("assign", F.filter(found("t", ASSIGN, 2), lambda x: F.length(x["value"]) >= 6)), tagged("access", found("t", ACCESS)), tagged("hex", found("t", HEX))).alias("known"),
        F.filter(found("t", TOKEN), lambda x: is_candidate(x["value"])).alias("tokens"),
    )

    def scored(x: Column) -> Column:
        return let(battery(x["value"]), lambda b: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), token_class(b["symbols"], x["value"]).alias("class"), b["log_p"].alias("log_p"), b["bits"].alias("bits")))

    tokens = persisted(known.select("id", "known", F.transform(outside(F.col("tokens"), F.col("known")), scored).alias("tokens")))
    tested = tokens.select(F.explode("tokens").alias("x")).select("x.class", "x.log_p").where(F.col("log_p").isNotNull())
    drawn = random_tokens(docs.sparkSession).select("class", battery(F.col("value"))["log_p"].alias("log_p"))
    # One row, with at most one cut for each class.
    cuts = report_cuts(tested, drawn, q).agg(F.map_from_entries(F.collect_list(F.struct("class", "cut"))).alias("cuts"))
    judged = tokens.crossJoin(F.broadcast(cuts))
    random = F.filter("tokens", lambda x: F.coalesce((x["bits"] >= least_bits) & (x["log_p"] < F.coalesce(F.col("cuts")[x["class"]], F.lit(0.0))), F.lit(False)))
    spans = F.array_sort(F.concat("known", tagged("random", random)))
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return judged.select(
        F.col("id").alias(id_col),
        F.transform(spans, lambda x: F.struct(kinds[x["k"]].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"))).alias("spans"),
    )


def span_text(spans: Column) -> Column:
    """kind:start:stop of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")
