"""The driver's contract also holds where the training-data operators are taken away."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SEE = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); print(len(q), sum(k.startswith('op') or k == 'pipeline' for k in q), set(o) <= set(q))"


@pytest.mark.parametrize("gone", [("logloom/llm", "tests/llm"), ("logloom/llm", "tests/llm", "corpus_pipeline.py")])
def test_entry_without_llm(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "__pycache__", "spark-warehouse"))
    for g in gone:
        path = copy / g
        if path.is_dir():
            shutil.rmtree(path)
        elif path.exists():
            path.unlink()
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SEE], cwd=copy, env=env | {"PYTHONDONTWRITEBYTECODE": "1"}, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 40 and out[1:] == ["0", "True"]
