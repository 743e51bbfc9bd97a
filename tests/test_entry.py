"""The driver's contract: the entry module works with the llm folders and without them."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]


def test_names_of_queries_and_sql_agree():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_works_without_the_llm_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(REPO, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n.startswith('op')]; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, env=os.environ | {"PYTHONPATH": str(copy)}, check=True, timeout=120)


def test_nothing_else_imports_the_llm_folders():
    for path in REPO.rglob("*.py"):
        inside = path.relative_to(REPO).parts
        if "llm" not in inside and path.name not in ("corpus_pipeline.py", "__spark_entry__.py", "test_entry.py"):
            assert ".llm" not in path.read_text() and "corpus_pipeline" not in path.read_text(), path
