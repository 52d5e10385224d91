"""The entry point with and without the subpackage for training text."""

import os
import shutil
import subprocess
import sys

import pytest

from velograph.plans import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def names_in(folder):
    code = "import __spark_entry__ as e; print(' '.join(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    run = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True)
    return run.stdout.split(), run.stderr


@pytest.mark.parametrize("left", ["nothing", "an empty folder", "a cache", "the pipeline"])
def test_other_queries_without_the_subpackage(tmp_path, left):
    shutil.copytree(f"{ROOT}/velograph", tmp_path / "velograph", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    (tmp_path / "velograph" / "llm").mkdir()
    if left == "nothing":
        (tmp_path / "velograph" / "llm").rmdir()
    if left == "a cache":
        (tmp_path / "velograph" / "llm" / "__pycache__").mkdir()
    if left == "the pipeline":
        (tmp_path / "corpus_pipeline.py").write_text("from velograph.llm import quality\nQUERIES, ORACLE_SQLS = {}, {}\n")
    assert names_in(tmp_path)[0] == list(QUERIES)


def test_a_broken_subpackage_is_not_taken_for_an_absent_one(tmp_path):
    shutil.copytree(f"{ROOT}/velograph", tmp_path / "velograph", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{ROOT}/__spark_entry__.py", tmp_path)
    (tmp_path / "velograph" / "llm").mkdir()
    (tmp_path / "velograph" / "llm" / "__init__.py").write_text("import no_such_module\n")
    names, errors = names_in(tmp_path)
    assert names == [] and "no_such_module" in errors
