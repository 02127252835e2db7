import random
import re
import unicodedata

from barloom.llm.line_dedup import line_dedup
from barloom.llm.queries import op10_line_dedup
from tests.llm.rows import awkward, empty, lower

MARKS = {"line": "\n", "sentence": "\n.?!", "clause": "\n.?!,;:"}


def is_word(c):
    return unicodedata.category(c)[0] in "LN"


def units(text, marks):
    """[(words as (start, stop, lower-cased)), ...] of every unit with a word."""
    out, k = [[]], 0
    while k < len(text):
        if text[k] in marks:
            out.append([])
            k += 1
        elif is_word(text[k]):
            end = k
            while end < len(text) and is_word(text[end]):
                end += 1
            out[-1].append((k, end, lower(text[k:end])))
            k = end
        else:
            k += 1
    return [u for u in out if u]


def span(text, start, stop):
    line = text.rfind("\n", 0, start) + 1
    if not any(map(is_word, text[line:start])):
        start = line + len(text[line:start]) - len(text[line:start].lstrip())
    end = text.find("\n", stop)
    rest = text[stop : len(text) if end < 0 else end]
    if not any(map(is_word, rest)):
        return start, stop + len(rest.rstrip())
    while not text[stop].isspace() and not is_word(text[stop]):
        stop += 1
    return start, stop


def brute(rows, unit, least):
    """Every unit as a tuple of words; the first one by (identifier, place) stays."""
    first, out = {}, []
    texts = [(d, t, units(t, MARKS[unit]) if d is not None and t is not None else []) for d, t in rows]
    for d, _, found in sorted((r for r in texts if r[2]), key=lambda r: r[0]):
        for k, u in enumerate(found):
            first.setdefault(tuple(w[2] for w in u), (d, k))
    for d, t, found in texts:
        runs, open_ = [], False
        for k, u in enumerate(found):
            again = first[tuple(w[2] for w in u)] != (d, k)
            if again and open_:
                runs[-1] += u
            elif again:
                runs.append(list(u))
            open_ = again
        spans = [(*span(t, r[0][0], r[-1][1]), len(r)) for r in runs if len(r) >= least]
        at, kept = 0, []
        for s, e, _ in spans:
            kept.append(t[at:s])
            at = e
        out.append((d, None if t is None else "".join(kept) + t[at:], spans))
    return sorted(out, key=str)


def check(docs, **options):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = line_dedup(docs, **options)
    assert got.columns == ["doc_id", "text", "removed", "n_removed_words"]
    assert sorted(((r.doc_id, r.text, [tuple(s) for s in r.removed]) for r in got.collect()), key=str) == brute(rows, options.get("unit", "clause"), options.get("least_words", 15))


def test_against_brute_force(spark):
    rng = random.Random(12)
    pieces = ["One two.", "three, four;", "É f\n", "\n\n", "five six seven?", "!!", "  x", "\U0001f600 y:"]
    docs = spark.createDataFrame([(i, "".join(rng.choices(pieces, k=rng.randint(0, 12)))) for i in range(200)], "doc_id bigint, text string")
    for unit in ("line", "sentence", "clause"):
        for least in (1, 3, 15):
            check(docs, unit=unit, least_words=least)


def test_passage_inside_lines_goes_once(spark):
    rng = random.Random(13)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    passage = f"{words(14)}. {words(20)}. {words(18)}."
    rows = [(i, f"{words(30)}. {words(5)} {passage} {words(4)}. {words(30)}.") for i in range(20)] + [(50 + i, f"{words(40)}. {words(9)}.") for i in range(20)]
    got = {r.doc_id: r for r in line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[0].removed == [] and all(got[i].n_removed_words >= 38 for i in range(1, 20)) and all(got[50 + i].removed == [] for i in range(20))


def test_repeated_short_lines_go_whatever_stands_beside_them(spark):
    licence = "This work is licensed under the GNU General Public License, version 3."
    rows = [(i, f"Own text {i} a.\n{licence}\nOwn text {i} b.") for i in range(5)] + [(7, f"Here {licence}\nStay."), (8, "Stay.\nNew 8\nNEW 8!\nnew, 8"), (9, f"x {licence}\n\n{licence.upper()}\nEnd")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in line_dedup(docs, whole_lines=True).collect()}
    assert got[0].removed == [] and all(got[i].text == f"Own text {i} a.\n\nOwn text {i} b." and got[i].n_removed_words == 12 for i in range(1, 5))
    assert got[7].text == rows[5][1] and got[8].text == "\nNew 8\n" and got[8].n_removed_words == 5
    assert got[9].text == f"x {licence}\n\n\nEnd"
    assert all(r.removed == [] for r in line_dedup(docs).collect())


def test_passage_cut_by_long_clauses_goes_to_the_word(spark):
    rng = random.Random(14)
    words = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    passages = [words(52), f"{words(10)} {'it ' * 40}{words(12)}", f"{words(20)}, {words(9)}. {words(30)}"]
    rows = [(10 * k + i, f"{words(40 + i)} {p} {words(50 - i)}") for k, p in enumerate(passages) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in line_dedup(docs, unit="passage").collect()}
    for d, text in rows:
        gone = " ".join(text[s.start : s.stop] for s in got[d].removed)
        if d != 10:  # which repeats its own words
            assert gone == (passages[d // 10] if d % 10 else ""), d
    assert sum(r.n_removed_words for r in line_dedup(docs.where("doc_id < 10")).collect()) == 0


def test_clauses_that_never_stood_together_are_no_passage(spark):
    rng = random.Random(15)
    clauses = [" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(6)) + "." for _ in range(8)]
    rows = [(k, f"Own {k}. {c} Own {k} end.") for k, c in enumerate(clauses)] + [(20, " ".join(clauses))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert all(r.removed == [] for r in line_dedup(docs, unit="passage").collect())
    assert [r.n_removed_words for r in line_dedup(docs).where("doc_id = 20").collect()] == [48]


def test_query_removes_every_repeated_line(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    seen, later = set(), {}
    for d in sorted(docs):
        for line in docs[d].split("\n"):
            key = " ".join(re.findall(r"[^\W_]+", lower(line)))
            if key and key in seen:
                later[d] = later.get(d, 0) + len(key.split())
            seen.add(key)
    got = {r.doc_id: r.n_removed_words for r in op10_line_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert later and all(got[d] >= n for d, n in later.items())


def test_query_removes_repeated_passages_and_nothing_else(spark):
    """Against sets of word windows of all documents: of words in 51-word windows of earlier documents under 1 % stay, and every removed run of words stands in the text of another place."""
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    words = {d: [(m.start(), m.group()) for m in re.finditer(r"[^\W_]+", lower(t))] for d, t in docs.items()}
    got = {r.doc_id: r.removed for r in line_dedup(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), unit="passage", whole_lines=True).collect()}
    seen, due, left, other, lines = set(), 0, 0, 0, set()
    grams = {}
    for d in sorted(docs):
        own = [w for _, w in words[d]]
        for k in range(len(own) - 7):
            grams.setdefault(tuple(own[k : k + 8]), []).append((d, k))
        windows = [tuple(own[k : k + 51]) for k in range(len(own) - 50)]
        hit = set()
        for k, w in enumerate(windows):
            if w in seen:
                hit |= set(range(k, k + 51))
        seen.update(windows)
        gone = {k for k, (at, _) in enumerate(words[d]) for s in got[d] if s.start <= at < s.stop}
        due, left = due + len(hit), left + len(hit - gone)
    for d in sorted(docs):
        own = [w for _, w in words[d]]
        for s in got[d]:
            inside = [k for k, (at, _) in enumerate(words[d]) if s.start <= at < s.stop]
            if s.words >= 15:
                other += sum(len(grams[tuple(own[k : k + 8])]) < 2 for k in inside[:-7])
    assert due > 10_000 and left < 0.01 * due
    total = sum(s.words for spans in got.values() for s in spans)
    assert other < 0.05 * total, (other, total)  # where runs and lines of several places meet


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark).where("doc_id is null or doc_id <> 5")
    check(docs)
    check(docs, least_words=1)
    check(empty(spark))
    assert line_dedup(awkward(spark)).count() == 12


def test_query_columns(spark):
    got = op10_line_dedup(spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "n_removed", "n_removed_words", "removed", "n_chars_left", "text_sha256"] and got.count() == 1000
