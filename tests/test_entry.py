"""The entry points without the text operators."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SAYS = """
import __spark_entry__ as entry
assert entry.__file__.startswith({folder!r})
names = set(entry.queries())
assert "cogs_report" in names and not [n for n in names if n.startswith("op") or n == "pipeline"], names
assert set(entry.oracle_sql()) <= names
"""


@pytest.mark.parametrize("pipeline", [True, False])
def test_the_rest_works_without_the_text_operators(tmp_path, pipeline):
    folder = str(tmp_path / "copy")
    left_out = ["llm", ".git", "tests", "__pycache__", *([] if pipeline else ["corpus_pipeline.py"])]
    shutil.copytree(REPO, folder, ignore=shutil.ignore_patterns(*left_out))
    assert os.path.exists(f"{folder}/corpus_pipeline.py") == pipeline
    ended = subprocess.run([sys.executable, "-c", SAYS.format(folder=folder)], cwd=folder, capture_output=True, text=True)
    assert ended.returncode == 0, ended.stderr
