"""The library without the corpus operators: entry and registry must work when their folders are gone."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
import __spark_entry__ as entry
names = set(entry.queries())
assert len(names) > 100 and not [n for n in names if n.startswith("op") and n[2:3].isdigit()], names
assert "pipeline" not in names and set(entry.oracle_sql()) <= names
import tests.test_oracle
"""


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_without_corpus_operators(tmp_path, with_pipeline):
    left_out = {os.path.join(ROOT, "tallyforge", "llm"), os.path.join(ROOT, "tests", "llm"), os.path.join(ROOT, ".git")}
    if not with_pipeline:
        left_out.add(os.path.join(ROOT, "corpus_pipeline.py"))
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if os.path.join(folder, n) in left_out or n == "__pycache__"])
    done = subprocess.run([sys.executable, "-c", RUN], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(copy)}, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
