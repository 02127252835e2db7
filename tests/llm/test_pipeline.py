import random

from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import common, quality
from tests.llm.test_decontamination import brute as brute_hits
from tests.llm.test_near_dedup import brute as brute_groups

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_and_keep_columns(spark):
    docs = common.table(spark, SF, "documents")
    columns = docs.columns
    kept = {name: None for name, _ in corpus_pipeline.STAGES}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {(r.doc_id, r.text) for r in docs.collect()}
        docs = common.persisted(stage(spark, docs, SF))
        assert docs.columns == columns
        rows = docs.collect()
        kept[name] = [(r.doc_id, r.text) for r in rows]
        assert set(kept[name]) <= before
        if name == "quality":
            source = common.table(spark, SF, "documents")
            model = quality.fit_quality(source, common.table(spark, SF, "labels"), may_learn=~common.is_held_out(F.col("id")))
            good = {r.doc_id for r in quality.quality_scores(source, model).where("score >= 0.7").collect()}
            assert {d for d, _ in kept[name]} == good and 0.5 * len(before) < len(good) < len(before)
        if name == "near_dedup":
            assert sorted(d for d, _ in kept[name]) == sorted(d for d, _, _, k in brute_groups(sorted(before), 5) if k)
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in common.table(spark, SF, "benchmark").collect()]
            clean = {d for d, n, hit, _ in brute_hits(sorted(before), items, 13) if not (hit and 20 * hit >= n)}
            assert {d for d, _ in kept[name]} == clean
        if name == "mixing":
            assert set(kept[name]) == before
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, _ in kept["mixing"])


def test_run_equals_the_stages(spark):
    docs = common.table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, common.persisted(docs), SF)
    key = lambda rows: sorted(str(r) for r in rows)
    assert key(corpus_pipeline.run(spark, SF).collect()) == key(docs.collect())


def test_awkward_rows_and_columns_pass_every_stage(spark, tmp_path):
    """Nulls in every column, empty and long texts, ties and repeated rows, and columns with odd names or the names that stages use inside."""
    rng = random.Random(15)
    names = ["odd.name", "row", "score", "spans", "items", "id", "h", "key", "copies", "component_id", "kept", "n_hit", "__quality_score", "__mixing_row", "a`b"]
    extra = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    text = lambda k: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(k))
    long_ = text(60_000)
    texts = [text(40) for _ in range(40)] + ["", None, " ", long_, long_ + " x", "one two three"]
    rows = [(i, t, "en", rng.choice(["a", "b"]), 1, *names) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[4], None, None, None, *[None] * len(names)), (None, None, None, None, None, *[None] * len(names)), (900, texts[5], None, None, None, *names)]
    docs = spark.createDataFrame(rows, f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}")
    spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (2, None)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([("q", texts[7]), (None, texts[8]), ("r", None)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    key = lambda r: str(tuple(r))
    every = {key(r) for r in docs.collect()}
    gone = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
        found = out.collect()
        assert {key(r) for r in found} <= every
        gone[name] = every - {key(r) for r in found}
        assert len(found) >= len(rows) if name == "mixing" else len(found) <= len(rows)
        assert stage(spark, docs.limit(0), str(tmp_path)).collect() == []
    assert {r.split(",")[0] for r in gone["near_dedup"]} == {"(44", "(900"} and {r.split(",")[0] for r in gone["decontamination"]} == {"(7", "(8"} and not gone["mixing"]
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, str(tmp_path)).count() == len(rows) and last(spark, docs.limit(0), str(tmp_path)).collect() == []


def test_files_that_are_left_out_are_no_error_but_broken_ones_are(tmp_path):
    import importlib.util
    import os
    import shutil
    import subprocess
    import sys

    root = importlib.util.find_spec("corpus_pipeline").origin.rpartition("/")[0]
    for part in ("barloom", "__spark_entry__.py"):
        (shutil.copytree if part == "barloom" else shutil.copy)(f"{root}/{part}", tmp_path / part)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}  # which may lead to the repository
    say = lambda: subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sum(n.startswith('op') for n in e.queries()), 'pipeline' in e.queries())"], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert say().stdout.split() == ["13", "False"]
    module = tmp_path / "barloom/llm/secrets.py"
    module.write_text(module.read_text() + "\nimport no_such_module\n")
    assert "no_such_module" in say().stderr
    shutil.rmtree(tmp_path / "barloom/llm")
    assert say().stdout.split() == ["0", "False"]
