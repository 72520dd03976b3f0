"""The library without its optional part: the folders of the training-data operators are left out of a copy."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

from streamlytics import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), e.llm, e.pipeline)"


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_imports_and_keeps_its_queries(tmp_path, pipeline):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns("llm", ".git", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"])))
    assert (copy / "corpus_pipeline.py").exists() is (pipeline and os.path.exists(os.path.join(ROOT, "corpus_pipeline.py")))
    env = {**os.environ, "PYTHONDONTWRITEBYTECODE": "1", "PYTHONPATH": ""}
    found = subprocess.run([sys.executable, "-c", SAYS], cwd=copy, env=env, capture_output=True, text=True, check=True)
    assert found.stdout.split() == [str(len(catalog.queries())), str(len(catalog.oracle_sql())), "None", "None"]
