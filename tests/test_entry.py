"""The driver's entry module, with and without the training-data subpackage."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).parent.parent


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert "ts_ms" in df.columns and df.limit(1).count() == 1


def test_rest_works_without_the_subpackage(tmp_path):
    for name in ("sluice", "__spark_entry__.py"):
        source = ROOT / name
        copy = shutil.copytree if source.is_dir() else shutil.copy
        copy(source, tmp_path / name)
    shutil.rmtree(tmp_path / "sluice/llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); print(len(q), any(n[:2] == 'op' and n[2].isdigit() for n in q), 'pipeline' in q, len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 40 and out[1:3] == ["False", "False"] and out[3] == out[0]


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "sluice").rglob("*.py"):
        if "llm" not in path.parts:
            assert "sluice.llm" not in path.read_text()
