"""The contract's module without the corpus operators or one of their libraries."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BLOCK = """
import importlib.abc, sys, warnings
class Block(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Block())
warnings.simplefilter("ignore")
import __spark_entry__ as entry
print(sum(q.startswith("op") for q in entry.queries()), "top_users" in entry.queries())
"""


def run(name):
    done = subprocess.run([sys.executable, "-c", BLOCK.format(name=name)], cwd=ROOT, capture_output=True, text=True)
    return done.stdout.strip().splitlines()[-1] if done.returncode == 0 else done.stderr


@pytest.mark.parametrize("library", ["xxhash", "public_tokenizers", "hiatus.llm.queries"])
def test_without_a_library_the_other_queries_stay(library):
    assert run(library) == "0 True"


def test_a_module_that_is_missing_inside_raises():
    if not os.path.exists(f"{ROOT}/hiatus/llm/tables.py"):
        pytest.skip("the corpus operators are not installed")
    assert "ModuleNotFoundError" in run("hiatus.llm.tables")
