"""The library without its language-model folders: everything else still imports and is registered."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), sum(n.startswith('op') or n == 'pipeline' for n in q), len(e.oracle_sql()))"


@pytest.mark.parametrize("without_pipeline", [False, True])
def test_rest_stands_alone(tmp_path, without_pipeline):
    skip = shutil.ignore_patterns("llm", ".git", "__pycache__", *(["corpus_pipeline.py"] if without_pipeline else []))
    shutil.copytree(ROOT, tmp_path / "repo", ignore=skip)
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=tmp_path / "repo", capture_output=True, text=True, check=True).stdout.split()
    assert out == ["192", "0", "192"]
