"""The entry points in copies of the repository from which the corpus folders were taken out."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SAYS = """
import __spark_entry__ as e, bench
from tidemark.workloads import all_workloads
names = set(e.queries())
assert names == set(all_workloads()) and "upsert" in names, names
assert set(e.oracle_sql()) <= names
"""


def copy(to: Path) -> Path:
    for name in ("tidemark", "__spark_entry__.py", "bench.py", "corpus_pipeline.py"):
        if (ROOT / name).is_dir():
            shutil.copytree(ROOT / name, to / name, ignore=shutil.ignore_patterns("__pycache__"))
        elif (ROOT / name).exists():
            shutil.copy(ROOT / name, to / name)
    return to


def says(folder: Path, text: str) -> subprocess.CompletedProcess:
    return subprocess.run([sys.executable, "-c", text], cwd=folder, capture_output=True, text=True, timeout=120)


@pytest.mark.parametrize("pipeline", [True, False])
@pytest.mark.parametrize("left_over", [True, False])
def test_without_the_corpus_folders(tmp_path, pipeline, left_over):
    folder = copy(tmp_path)
    shutil.rmtree(folder / "tidemark/llm", ignore_errors=True)
    if left_over:
        (folder / "tidemark/llm/__pycache__").mkdir(parents=True)
    if not pipeline:
        (folder / "corpus_pipeline.py").unlink(missing_ok=True)
    done = says(folder, SAYS)
    assert done.returncode == 0, done.stderr


def test_its_own_failures_show(tmp_path):
    folder = copy(tmp_path)
    (folder / "tidemark/llm").mkdir(exist_ok=True)
    (folder / "tidemark/llm/__init__.py").touch()
    (folder / "tidemark/llm/queries.py").write_text("import no_such_module\n")
    done = says(folder, "import __spark_entry__ as e; e.queries()")
    assert done.returncode != 0 and "no_such_module" in done.stderr
