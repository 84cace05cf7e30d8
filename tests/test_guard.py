"""The core queries without the training-data operators, in whatever way these are absent."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.core_queries()), set(e.oracle_sql()) >= set(e.core_queries()))"


def counted(folder, before=""):
    ran = subprocess.run([sys.executable, "-B", "-c", before + COUNT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert ran.returncode == 0, ran.stderr
    return ran.stdout.split()


@pytest.fixture
def copy(tmp_path):
    shutil.copytree(REPO / "tagshelf", tmp_path / "tagshelf", ignore=shutil.ignore_patterns("__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (REPO / name).exists():
            shutil.copy(REPO / name, tmp_path)
    return tmp_path


@pytest.mark.parametrize("left", ["nothing", "empty", "no pipeline"])
def test_without_the_folder(copy, left):
    if left == "no pipeline":
        (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    else:
        shutil.rmtree(copy / "tagshelf" / "llm", ignore_errors=True)
        if left == "empty":
            (copy / "tagshelf" / "llm" / "__pycache__").mkdir(parents=True)
    every, core, covered = counted(copy)
    assert every == core and covered == "True"


@pytest.mark.parametrize("library", ["tiktoken", "public_tokenizers"])
def test_without_a_library(copy, library):
    every, core, covered = counted(copy, f"import sys; sys.modules['{library}'] = None; ")
    assert every == core and covered == "True"


def test_without_the_pipeline_but_another_on_the_path(copy, tmp_path, monkeypatch):
    other = tmp_path / "other"
    other.mkdir()
    (copy / "corpus_pipeline.py").unlink(missing_ok=True)
    (other / "corpus_pipeline.py").write_text("ORACLE_SQL = None\n\n\ndef run(spark, sf_dir):\n    return None\n")
    monkeypatch.setenv("PYTHONPATH", str(other), prepend=os.pathsep)
    every, core, covered = counted(copy)
    assert every == core and covered == "True"
