"""The other queries work without the corpus operators."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
ASK = "import __spark_entry__ as e; print(sorted(e.queries())); print(sorted(e.oracle_sql()))"


def test_entry_imports_without_the_corpus_operators(tmp_path):
    without = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(ROOT / "txmill", tmp_path / "txmill", ignore=without)
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    (tmp_path / "txmill/llm/__pycache__").mkdir(parents=True)
    done = subprocess.run(
        [sys.executable, "-c", ASK], cwd=tmp_path, capture_output=True, text=True, check=False
    )
    assert done.returncode == 0, done.stderr
    assert "'clean_transactions'" in done.stdout and "op1_" not in done.stdout
    assert "pipeline" not in done.stdout
