"""The entry without the parts that can be taken out of the repository."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parents[1]
TAKEN = "llm", "corpus_pipeline.py"
SCRIPT = """
import __spark_entry__ as entry
names = set(entry.queries())
assert set(entry.oracle_sql()) <= names
print(len(names), sorted(n for n in names if n.startswith("op") or n == "pipeline"))
"""


def _listed(folder: Path, script: str = SCRIPT) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", script], cwd=folder, capture_output=True, text=True, timeout=120, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": f"{folder}:{':'.join(p for p in sys.path if p and not p.startswith(str(REPO)))}"})


def _copy(folder: Path, *left_out: str) -> Path:
    shutil.copytree(REPO, folder, ignore=shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *left_out))
    return folder


@pytest.mark.parametrize("left_out", [TAKEN, TAKEN[:1]])
def test_entry_lists_the_rest(tmp_path, left_out):
    ran = _listed(_copy(tmp_path / "copy", *left_out))
    assert ran.returncode == 0, ran.stderr[-2000:]
    number, texts = ran.stdout.split(" ", 1)
    assert int(number) >= 69 and texts.strip() == "[]"


def test_other_missing_modules_are_errors(tmp_path):
    if not (REPO / "tillworks" / "llm").exists():
        pytest.skip("the part is not there")
    copy = _copy(tmp_path / "copy")
    (copy / "tillworks" / "llm" / "pii.py").write_text("import no_such_module\n")
    ran = _listed(copy)
    assert ran.returncode != 0 and "no_such_module" in ran.stderr
