import math
import random

import numpy as np
from pyspark.sql import functions as F

from barloom.llm.common import is_held_out, table
from barloom.llm.quality import STATISTICS, fit_quality, grow, quality_scores, statistics
from barloom.llm.queries import op3_quality
from tests.llm.rows import awkward, empty

SF = "/root/testdata/sf0.01"


def walk_one(trees, row):
    total = trees.start
    for f, t, v in zip(trees.feature, trees.threshold, trees.value):
        node = 0
        while node < len(f):
            node = 2 * node + (2 if row[f[node]] > t[node] else 1)
        total += v[node - len(f)]
    return 1 / (1 + np.exp(-total))


def test_flat_trees_equal_a_walk_row_by_row():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = grow(x, y, trees=30, depth=3)
    p = trees.score(x)
    assert np.allclose(p, [walk_one(trees, r) for r in x])
    assert ((p > 0.5) == (y == 1)).mean() > 0.97


def test_statistics_have_a_fixed_width():
    texts = ["", " ", "a", "é" * 50, "A!! B!! C!!", "x | y\n" * 3000, "\ud800", "ǅ ab", "\x1c"]
    rows = statistics(texts)
    assert rows.shape == (len(texts), len(STATISTICS)) and np.isfinite(rows).all() and statistics([]).shape == (0, len(STATISTICS))


def test_held_out_accuracy(spark):
    scored = op3_quality(spark, SF)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"] and scored.count() == table(spark, SF, "documents").count()
    rows = scored.where("held_out").join(table(spark, SF, "labels"), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.9 and all(0 <= r.score <= 1 for r in rows)


def test_scores_do_not_depend_on_labels_of_held_out_rows(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    flipped = labels.withColumn("quality", F.when(is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (fit_quality(docs, x, may_learn=~is_held_out(F.col("id"))) for x in (labels, flipped))
    assert np.array_equal(a.value, b.value) and np.array_equal(a.threshold, b.threshold)


def test_awkward_rows_and_empty_tables(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (5, 0), (None, 1), (8, None)], "doc_id bigint, quality int")
    model = fit_quality(awkward(spark), labels)
    assert len(quality_scores(awkward(spark), model).collect()) == 12
    assert quality_scores(empty(spark), model).collect() == []
    blank = fit_quality(empty(spark), labels.limit(0))
    assert {r.score for r in quality_scores(awkward(spark), blank).collect()} == {0.5}


def plain_statistics(text):
    """The statistics written out one by one over characters and words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = text.split()
    if not words:
        return [math.log1p(len(raw))] + [0.0] * 25
    n, total = len(words), len(raw)
    count = lambda test: sum(1 for b in raw if test(b))
    times = {w: words.count(w) for w in words}
    most = sorted(times.values(), reverse=True)
    lengths = [len(w) for w in words]
    mean = sum(lengths) / n
    lines = [x for x in text.split("\n") if x.strip()]
    upper, lower, digits = count(lambda b: 65 <= b <= 90), count(lambda b: 97 <= b <= 122), count(lambda b: 48 <= b <= 57)
    space, beyond = count(lambda b: b == 32 or 9 <= b <= 13), count(lambda b: b >= 128)
    pairs = [(words[k], words[k + 1]) for k in range(n - 1)]
    return [
        math.log1p(total), math.log1p(n), mean, math.sqrt(sum((x - mean) ** 2 for x in lengths) / n), max(lengths), upper / total, digits / total, (total - upper - lower - digits - space - beyond) / total,
        count(lambda b: chr(b) in "#$%&*@^~<>{}[]\\_=+") / total, raw.count(b"!") / total, raw.count(b"|") / total, beyond / total, space / total, len(times) / n, most[0] / n, sum(most[:5]) / n, 1 - len(set(pairs)) / max(1, n - 1),
        sum(a == b for a, b in pairs) / n, math.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)), n / max(1, len(lines)), raw.count(b".") / n, sum(w.isupper() for w in words) / n, sum(w[0].isupper() for w in words) / n,
        sum(not any(c.isalnum() for c in w) for w in times) / len(times), sum(words[k] == words[k + 2] for k in range(n - 2)) / n,
    ]


def test_statistics_equal_plain_counts():
    rng = random.Random(2)
    alphabet = ["a", "B", "ß", "É", "9", "!", "|", ".", "#", " ", " ", "\n", "\t", "the ", "THE ", "...", "\U0001f600", " ", "\n\n"]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 80))) for _ in range(300)] + ["", "ǅ Ǆ a", "\ud800 x", "\x1c\x1d", "a" * 70 + " b"]
    for text, row in zip(texts, statistics(texts)):
        assert np.allclose(row, plain_statistics(text)), repr(text)


def plain_trees(x, y, trees, depth, rate, bins, smooth, least):
    """Boosted trees grown node by node over lists of rows, thresholds from the same quantiles; returns the score of each row."""
    n, width = len(x), len(x[0])
    share = (sum(y) + 1) / (n + 2)
    score = [math.log(share / (1 - share))] * n
    edges = [sorted(set(np.quantile([r[f] for r in x], np.linspace(0, 1, bins + 1)[1:-1], method="lower").tolist())) for f in range(width)]

    def gain_of(rows, g, h):
        return sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + smooth)

    for _ in range(trees):
        p = [1 / (1 + math.exp(-s)) for s in score]
        g, h = [a - b for a, b in zip(y, p)], [max(b * (1 - b), 1e-6) for b in p]
        leaves = [list(range(n))]
        for _ in range(depth):
            new = []
            for rows in leaves:
                best, at = 1e-9, None
                for f in range(width):
                    for e in edges[f]:
                        left, right = [i for i in rows if x[i][f] <= e], [i for i in rows if x[i][f] > e]
                        if len(left) >= least and len(right) >= least:
                            gain = gain_of(left, g, h) + gain_of(right, g, h) - gain_of(rows, g, h)
                            if gain > best + 1e-12:
                                best, at = gain, (f, e)
                new += [[i for i in rows if at is None or x[i][at[0]] <= at[1]], [] if at is None else [i for i in rows if x[i][at[0]] > at[1]]]
            leaves = new
        for rows in leaves:
            value = rate * sum(g[i] for i in rows) / (sum(h[i] for i in rows) + smooth)
            for i in rows:
                score[i] += value
    return [1 / (1 + math.exp(-s)) for s in score]


def test_trees_equal_trees_grown_row_by_row():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(70, 3)).round(1)
    y = ((x[:, 0] > 0.2) ^ (x[:, 2] > 0.5)).astype(float)
    options = {"trees": 4, "depth": 3, "rate": 0.3, "bins": 8, "smooth": 2.0, "least": 4}
    assert np.allclose(grow(x, y, **options).score(x), plain_trees(x.tolist(), y.tolist(), **options))
