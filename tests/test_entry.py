"""Without the training-data package everything else is still registered."""

import importlib
import os
import shutil
import subprocess
import sys

import __spark_entry__ as entry_module

REPO = os.path.dirname(os.path.abspath(entry_module.__file__))


def test_entry_when_an_import_of_the_package_fails(monkeypatch):
    monkeypatch.setitem(sys.modules, "tradeweave.llm.queries", None)
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    names = set(importlib.reload(entry_module).queries())
    assert "k9_ranked_letters_of_credit" in names and not any(n.startswith("op") or n == "pipeline" for n in names)
    assert set(entry_module.oracle_sql()) <= names


def test_entry_without_the_files(tmp_path):
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{REPO}/tradeweave", tmp_path / "tradeweave", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    told = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                          cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True, timeout=120)
    assert told.returncode == 0, told.stderr
    assert all(int(n) > 100 for n in told.stdout.split()[-2:])
