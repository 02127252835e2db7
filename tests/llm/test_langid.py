import random

import numpy as np
import pytest

from barloom.llm.common import table
from barloom.llm.langid import DIMENSIONS, WINDOW, fit, fit_language, predict_language, presence, spectra
from barloom.llm.queries import op7_language
from tests.llm.rows import awkward, empty

SF = "/root/testdata/sf0.01"


def test_kernel_counts_shared_ngrams():
    (a,), (b,) = spectra("abc abd"), spectra("abd xyz")
    k = presence([a]) @ presence([b]).T
    shared = len(set(a) & set(b))
    assert np.isclose(k[0, 0], shared / np.sqrt(len(a) * len(b))) and max(a) < DIMENSIONS
    assert np.array_equal(spectra("ABC  abd\n")[0], a)
    assert len(spectra("ab " * WINDOW)) == 3 and len(spectra("")) == 1


def ngrams(text):
    t = f" {' '.join(text.lower().split())} "
    return {t[k : k + n] for n in range(1, 5) for k in range(len(t) - n + 1)}


def test_prediction_equals_direct_solution_on_sets_of_strings():
    """Kernel, linear system and scores from Python sets of n-grams, without hashing, landmarks first in the list of each language."""
    rng = random.Random(3)
    sounds = {"xx": "aeiou kl", "yy": "abcdz ef", "zz": "aeghz lm"}
    rows = [(name, "".join(rng.choices(own, k=rng.randint(20, 60)))) for name, own in sounds.items() for _ in range(30 if name == "xx" else 12)]
    rng.shuffle(rows)
    langs, texts = [r[0] for r in rows], [r[1] for r in rows]
    names, each, ridge = sorted(sounds), 8, 0.5
    marks = [k for k in range(len(rows)) if langs[: k + 1].count(langs[k]) <= each]
    sets = [ngrams(t) for t in texts]
    kernel = lambda a, b: len(a & b) / np.sqrt(len(a) * len(b))
    c = np.array([[kernel(a, sets[m]) for m in marks] for a in sets])
    w = np.array([[kernel(sets[a], sets[b]) for b in marks] for a in marks])
    y = np.array([[float(x == n) for n in names] for x in langs])
    weight = np.diag([len(rows) / len(names) / langs.count(x) for x in langs])
    system = c.T @ weight @ c + ridge * w
    a = np.linalg.solve(system + 1e-6 * np.trace(c.T @ weight @ c) / len(w) * np.eye(len(w)), c.T @ weight @ y)
    new = ["".join(rng.choices(own, k=40)) for own in sounds.values() for _ in range(40)]
    direct = np.array([[kernel(ngrams(t), sets[m]) for m in marks] for t in new]) @ a
    model = fit([spectra(t)[0] for t in texts], langs, each, ridge)
    assert np.abs(model.values([spectra(t)[0] for t in new]) - direct).max() < 0.12  # hashed n-grams meet now and then
    predicted, scores = model.predict([spectra(t) for t in new])
    assert np.mean([p == names[k] for p, k in zip(predicted, direct.argmax(1))]) > 0.95 and ((scores > 1 / 3) & (scores <= 1)).all()


def test_long_texts_keep_their_score_and_every_language_is_learned(spark):
    rng = random.Random(5)
    word = lambda k: "".join(rng.choices([chr(0x4E00 + 40 * k + j) for j in range(30)], k=4))
    docs = spark.createDataFrame([(i, " ".join(word(i % 300) for _ in range(12)), f"l{i % 300}") for i in range(1500)], "doc_id bigint, text string, lang string")
    model = fit_language(docs, rows_each=4, landmarks_each=2)
    assert len(model.languages) == 300
    long_ = spark.createDataFrame([(k, " ".join(word(k) for _ in range(20_000))) for k in (7, 299)], "doc_id bigint, text string")
    short = spark.createDataFrame([(k, " ".join(word(k) for _ in range(20))) for k in (7, 299)], "doc_id bigint, text string")
    (a, b), (c, d) = predict_language(long_, model).orderBy("doc_id").collect(), predict_language(short, model).orderBy("doc_id").collect()
    assert [a.lang_pred, b.lang_pred, c.lang_pred, d.lang_pred] == ["l7", "l299"] * 2
    with pytest.raises(ValueError):
        fit_language(docs, most_landmarks=299)


def test_joined_texts_score_like_their_parts(spark):
    docs = table(spark, SF, "documents")
    model = fit_language(docs)
    rows = [r for r in docs.select("doc_id", "lang", "text").collect() if len(r.text) > 600]
    joined = [(lang, " ".join(r.text for r in rows if r.lang == lang)) for lang in ("de", "fr")]
    assert all(len(t) > 150_000 for _, t in joined)
    got = {r.lang: r for r in predict_language(spark.createDataFrame(joined, "lang string, text string"), model, "lang").collect()}
    assert all(r.lang_pred == k and r.score > 0.8 for k, r in got.items()), got


def test_sample_is_bounded_where_identifiers_repeat(spark):
    docs = spark.createDataFrame([(1, f"text number {k}", "en") for k in range(3000)] + [(2, "der hund", "de")], "doc_id bigint, text string, lang string")
    seen = []
    import barloom.llm.langid as langid

    plain, langid.fit = langid.fit, lambda sets, langs, *rest: seen.append(langs) or plain(sets, langs, *rest)
    try:
        fit_language(docs, rows_each=20)
    finally:
        langid.fit = plain
    assert seen == [["de"] + ["en"] * 20]


def test_held_out_accuracy(spark):
    found = op7_language(spark, SF)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"] and found.count() == 1000
    rows = found.where("held_out").join(table(spark, SF, "documents"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_awkward_rows_and_empty_tables(spark):
    model = fit_language(awkward(spark))
    got = [(r.doc_id, r.lang_pred, r.score) for r in predict_language(awkward(spark), model).collect()]
    assert len(got) == 12 and {p for d, p, _ in got if d in (3, 4, 7, 10)} == {"und"} and all(s == 0 for d, _, s in got if d == 4)
    assert predict_language(empty(spark), model).collect() == []
    blank = fit_language(empty(spark))
    assert {r.lang_pred for r in predict_language(awkward(spark), blank).collect()} == {"und"}
