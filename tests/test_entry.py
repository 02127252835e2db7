"""The contract module without the subpackage of training-data operators."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SAY = "import __spark_entry__ as e; n = e.queries(); print(len(n), len(e.oracle_sql()), any(x.startswith('op') for x in n), 'pipeline' in n)"


def test_entry_without_the_subpackage_whether_or_not_the_pipeline_is_there(tmp_path):
    from barloom.plans import events, sections, series, tables  # noqa: F401
    from barloom.plans.registry import ORACLES, QUERIES

    shutil.copytree(ROOT / "barloom", tmp_path / "barloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    expected = [str(len(QUERIES)), str(len(ORACLES)), "False", "False"]
    for with_pipeline in (False, True):
        if with_pipeline:
            (tmp_path / "corpus_pipeline.py").write_text("from barloom.llm import common\n")
        # No path of this process leads the child to the repository.
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        said = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, env=env, capture_output=True, text=True)
        assert said.stdout.split() == expected, said.stderr
