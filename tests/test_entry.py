"""The entry point with and without the corpus operators."""
from __future__ import annotations

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from faremeter.plans import registry

REPO = Path(__file__).resolve().parents[1]
_LIST = "import json, __spark_entry__ as e; print(json.dumps([sorted(e.queries()), sorted(e.oracle_sql())]))"


@pytest.fixture
def copy(tmp_path):
    """The repository without the corpus operators and what builds on them."""
    shutil.copytree(REPO / "faremeter", tmp_path / "faremeter", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    return tmp_path


@pytest.mark.parametrize("left_behind", [False, True])
def test_entry_without_the_corpus_operators(copy, left_behind):
    """Also with a `corpus_pipeline.py` that is left behind and can no longer be imported."""
    if left_behind:
        (copy / "corpus_pipeline.py").write_text("from faremeter.llm import linededup\n")
    run = subprocess.run([sys.executable, "-c", _LIST], cwd=copy, capture_output=True, text=True, check=True)
    queries, sqls = json.loads(run.stdout.strip().splitlines()[-1])
    assert queries == sorted(registry.QUERIES)
    assert sqls == sorted(registry.ORACLES)


def test_nothing_outside_imports_the_corpus_operators():
    for path in (REPO / "faremeter").rglob("*.py"):
        if "llm" not in path.relative_to(REPO).parts:
            assert "faremeter.llm" not in path.read_text() and "corpus_pipeline" not in path.read_text()


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
