"""The entry module works without the optional subpackage, and only its absence is excused."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'popular_countries' in q, any(k.startswith('op') or k == 'pipeline' for k in q))"


def copy_without(tmp, *left_out):
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp)
    shutil.copytree(os.path.join(ROOT, "innkeep"), tmp / "innkeep", ignore=shutil.ignore_patterns("__pycache__", *left_out))
    return subprocess.run([sys.executable, "-B", "-c", SHOW], cwd=tmp, env=os.environ | {"PYTHONPATH": ""}, capture_output=True, text=True)


def test_imports_without_the_subpackage_and_the_pipeline(tmp_path):
    done = copy_without(tmp_path, "llm")
    assert done.returncode == 0, done.stderr
    n, there, more = done.stdout.split()
    assert int(n) > 70 and (there, more) == ("True", "False")


def test_other_modules_do_not_import_the_subpackage():
    for folder, _, names in os.walk(os.path.join(ROOT, "innkeep")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as f:
                        assert "innkeep.llm" not in f.read(), name


@pytest.mark.parametrize("gone", ["zstandard", "sentencepiece", "innkeep.llm", "corpus_pipeline"])
def test_entry_without_a_library_or_the_pipeline(gone):
    """What the text operators need may be missing; corpus_pipeline.py stays in place."""
    code = f"import sys; sys.modules[{gone!r}] = None; import __spark_entry__ as e; print(len(e.queries()), any(k.startswith('op') for k in e.queries()), 'pipeline' in e.queries())"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    n, text, pipeline = done.stdout.split()
    assert int(n) >= 84 and (text, pipeline) == ("False", "False")
