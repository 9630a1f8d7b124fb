"""The library without its text operators: the folders are left out of a copy, with and without the pipeline's file."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("keep_pipeline", [True, False])
def test_entry_imports_without_the_text_operators(tmp_path, keep_pipeline):
    left_out = shutil.ignore_patterns("llm", ".git", "__pycache__", ".pytest_cache", *([] if keep_pipeline else ["corpus_pipeline.py"]))
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=left_out)
    code = ("import __spark_entry__ as E\nfrom tidewater.plans import registry as R\n"
            "assert set(E.queries()) == set(R.QUERIES) and set(E.oracle_sql()) == set(R.ORACLES)\n")
    env = {**os.environ, "PYTHONPATH": str(copy)}
    subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, check=True)
    collect = [sys.executable, "-m", "pytest", "--collect-only", "-q", "tests"]
    subprocess.run(collect, cwd=copy, env=env, check=True, stdout=subprocess.DEVNULL)
