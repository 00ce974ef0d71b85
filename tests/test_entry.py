"""The registered queries without the optional part or one of its libraries."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
COUNT = """
import sys
for name in sys.argv[1:]:
    sys.modules[name] = None
import __spark_entry__ as entry
queries, sql = entry.queries(), entry.oracle_sql()
assert set(sql) <= set(queries)
print(len(queries), sum(name.startswith("op") or name == "pipeline" for name in queries))
"""


def counted(folder, *blocked):
    out = subprocess.run(
        [sys.executable, "-c", COUNT, *blocked], cwd=folder, env={**os.environ, "PYTHONPATH": str(folder)}, capture_output=True, text=True
    )
    assert out.returncode == 0, out.stderr
    return [int(n) for n in out.stdout.split()]


@pytest.fixture(scope="module")
def copy(tmp_path_factory):
    """The repository without the optional part."""
    folder = tmp_path_factory.mktemp("bare") / "repo"
    shutil.copytree(ROOT, folder, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    return folder


def test_without_the_optional_part(copy):
    queries, optional = counted(copy)
    assert queries >= 40 and not optional


@pytest.mark.parametrize("library", ["tiktoken", "tokenizers", "public_tokenizers"])
def test_without_a_library(copy, library):
    queries, optional = counted(ROOT, library)
    assert queries == counted(copy)[0] and not optional
