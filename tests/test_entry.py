"""The entry file on copies of the repository without the corpus operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]
LIST = "import __spark_entry__ as e; q, s = e.queries(), e.oracle_sql(); assert set(s) <= set(q); print(*sorted(q))"
SOME = {"pipeline", "op1_", "a08_"}


@pytest.mark.parametrize(
    "gone, left",
    [
        ([], SOME),
        (["lendscape/llm"], {"a08_"}),  # the pipeline's file alone is no use
        (["lendscape/llm", "corpus_pipeline.py"], {"a08_"}),
        (["corpus_pipeline.py"], {"op1_", "a08_"}),
        (["lendscape/llm/*.py", "corpus_pipeline.py"], {"a08_"}),  # an empty folder stays behind
    ],
)
def test_entry_without_corpus_operators(tmp_path, gone, left):
    if not (ROOT / "lendscape/llm").is_dir():
        pytest.skip("no corpus operators here")
    out = [f for pattern in gone for f in ROOT.glob(pattern)]
    shutil.copytree(
        ROOT, tmp_path / "copy",
        ignore=lambda folder, names: [n for n in names if n.startswith(".") or n in ("tests", "__pycache__") or Path(folder, n) in out],
    )
    run = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    found = run.stdout.split()
    assert {p for p in SOME if any(n.startswith(p) for n in found)} == left


def test_other_import_errors_are_raised(tmp_path):
    shutil.copytree(ROOT, tmp_path / "copy", ignore=lambda folder, names: [n for n in names if n.startswith(".") or n in ("tests", "__pycache__", "llm")])
    (tmp_path / "copy/corpus_pipeline.py").write_text("import no_such_module\n")
    run = subprocess.run([sys.executable, "-c", LIST], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
    assert run.returncode and "no_such_module" in run.stderr
