"""The entry points without the training-data operators."""

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAID = "import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"


@pytest.mark.parametrize("pipeline_stays", [False, True])
def test_entry_without_training_data_operators(tmp_path, pipeline_stays):
    shutil.copytree(os.path.join(REPO, "lakeloom"), tmp_path / "lakeloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", *["corpus_pipeline.py"] * pipeline_stays):
        if os.path.exists(os.path.join(REPO, name)):
            shutil.copy(os.path.join(REPO, name), tmp_path)
    said = subprocess.run([sys.executable, "-c", SAID], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    queries, oracle = (set(line.split()) for line in said.stdout.splitlines())
    assert "O04_revenue_chain" in queries and oracle <= queries
    assert not any(q.startswith("op") or q == "pipeline" for q in queries)
