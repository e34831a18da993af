"""The entry works without the text operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import __spark_entry__ as entry
from conftest import session
names = entry.queries()
assert "scope_pairs" in names and "pipeline" not in names and not any(n.startswith("op1") for n in names)
assert set(entry.oracle_sql()) <= set(names)
assert names["scope_pairs"](session(), "/root/testdata/sf0.001").count() > 0
print("fine")
"""


def test_entry_without_the_text_folders(tmp_path):
    root = Path(__file__).resolve().parents[1]
    skipped = shutil.ignore_patterns(".git", "llm", "__pycache__", ".pytest_cache", "spark-warehouse")
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=skipped)
    assert (copy / "corpus_pipeline.py").exists() or not (root / "corpus_pipeline.py").exists()
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, timeout=600,
        env={"PATH": "/usr/bin:/bin", "PYTHONPATH": f"{copy}:{copy}/tests", **_java()},
    )
    assert done.stdout.strip().endswith("fine"), done.stderr[-2000:]


def _java() -> dict[str, str]:
    import os

    return {k: v for k, v in os.environ.items() if k in ("JAVA_HOME", "SPARK_HOME", "HOME", "PATH")}
