import random
import re

import numpy as np
import pytest

from barloom.llm.near_dedup import FOR_SKETCH, LEAST_ESTIMATE, SAMPLES, SKETCH_BITS, components, near_duplicates, odd_sketch, samples, shingle_hashes
from tests.llm.rows import awkward, empty, lower


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
    if not w:
        return set()
    n = min(size, len(w))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


def brute(rows, size, percent=80):
    sets = [shingles(t, size) for _, t in rows]
    label = list(range(len(rows)))

    def top(k):
        while label[k] != k:
            k = label[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                label[top(i)] = top(j)
    groups = {}
    for k, (d, _) in enumerate(rows):
        groups.setdefault(top(k), []).append(d)
    return sorted((d, len(sets[k]), min(groups[top(k)]), d == min(groups[top(k)])) for k, (d, _) in enumerate(rows))


def edited(rng, words, share):
    return [rng.choice("klmnop") + str(rng.randint(0, 99)) if rng.random() < share else w for w in words]


def test_against_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for g in range(40):
        source = [rng.choice("abcdefgh") + str(rng.randint(0, 30)) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.randint(1, 6)):
            rows.append(" ".join(edited(rng, source, rng.choice([0, 0.02, 0.05, 0.08]))))
    rng.shuffle(rows)
    rows = [(i * 3, t) for i, t in enumerate(rows)] + [(1, "One two"), (4, "one  TWO\n"), (7, "three"), (10, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for size in (2, 5):
        got = near_duplicates(docs, shingle_words=size)
        assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
        assert sorted(tuple(r) for r in got.collect()) == brute(rows, size)


def test_large_group_of_near_copies(spark):
    """Copies link through their centre, which isn't the smallest identifier, and some only through others."""
    rng = random.Random(10)
    source = [rng.choice("abcdefgh") + str(rng.randint(0, 400)) for _ in range(150)]
    rows = [(i + 1, " ".join(edited(rng, source, rng.uniform(0, 0.14)))) for i in range(220)] + [(900, " ".join(source))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(tuple(r) for r in near_duplicates(docs, shingle_words=2).collect()) == brute(rows, 2)


def test_large_group_just_below_the_threshold(spark):
    """Most pairs are near, but not linked; the links among them are found, and every pair is compared without leaving its block."""
    rng = np.random.default_rng(12)
    n, common = 2000, [f"c{k}" for k in range(620)]
    rows = []
    for i in range(n):
        words = list(common)
        for k in rng.choice(len(words), int(rng.integers(17, 22)), replace=False):
            words[k] = f"x{i if i % 50 else i % 100}n{k}"
        rows.append((i, " ".join(words)))
    sets = [shingles(t, 2) for _, t in rows]
    names = {x: k for k, x in enumerate(set().union(*sets))}
    table = np.zeros((n, len(names)), np.float32)
    for i, found in enumerate(sets):
        table[i, [names[x] for x in found]] = 1
    shared, size = table @ table.T, table.sum(1)
    linked = 100 * shared >= 80 * (size[:, None] + size - shared)
    similar = shared / (size[:, None] + size - shared)
    assert 0.74 < np.median(similar) < 0.8 and n < linked.sum() < n * n / 4
    label = np.arange(n)
    for _ in range(n):
        new = np.where(linked, label, n).min(1)
        if (new == label).all():
            break
        label = new
    got = {r.doc_id: r.component_id for r in near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), shingle_words=2).collect()}
    assert got == dict(enumerate(label.tolist()))


def test_awkward_rows_and_empty_table(spark):
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(awkward(spark), shingle_words=2).collect()}
    assert {(1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 3, 5, True), (7, 0, 7, True), (8, 1, 8, True), (9, 1, 9, True), (None, 2, None, True)} <= got
    assert near_duplicates(awkward(spark)).count() == 12
    assert near_duplicates(empty(spark)).collect() == []


def test_odd_sketch_estimates_high_similarity():
    rng = np.random.default_rng(3)
    common = rng.integers(0, 1 << 62, 900, dtype=np.uint64)
    errors = []
    for _ in range(30):
        a = np.unique(np.concatenate([common, rng.integers(0, 1 << 62, 100, dtype=np.uint64)]))
        b = np.unique(np.concatenate([common, rng.integers(0, 1 << 62, 100, dtype=np.uint64)]))
        z = int(np.bitwise_count(odd_sketch(samples(a, FOR_SKETCH)).view(np.uint64) ^ odd_sketch(samples(b, FOR_SKETCH)).view(np.uint64)).sum())
        estimate = 1 + SKETCH_BITS * np.log(1 - 2 * z / SKETCH_BITS) / (4 * SAMPLES)
        errors.append(estimate - 900 / 1100)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.02 and LEAST_ESTIMATE < 0.8 - 4 * 0.0135


def test_shingle_hashes_tell_sets_apart():
    assert len(shingle_hashes("a b a b a", 2)) == 2 and len(shingle_hashes("a", 5)) == 1 and not len(shingle_hashes(" \n\t", 2))
    assert list(shingle_hashes("X  y\u000bz", 2)) == list(shingle_hashes("x y z", 2))
    assert list(shingle_hashes("ab c", 2)) != list(shingle_hashes("a bc", 2))


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(11).shuffle(order)
    links = spark.createDataFrame([(order[k], order[k + 1]) for k in range(n - 1)] + [(1000, 1001)], "a bigint, b bigint")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {k: 0 for k in range(n)} | {1000: 1000, 1001: 1000}


def test_similarities_that_the_bands_would_miss_are_refused(spark):
    with pytest.raises(ValueError):
        near_duplicates(empty(spark), percent=79)
    assert near_duplicates(empty(spark), percent=80).collect() == []
