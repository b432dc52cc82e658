"""The entry imports without the training-data part, or without what that part needs."""

import subprocess
import sys

import pytest

from conftest import ROOT

HIDE = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(name)
sys.meta_path.insert(0, Hide())
sys.path.insert(0, {root!r})
import __spark_entry__ as e
assert "genre_rollup" in e.queries() and "genre_rollup" in e.oracle_sql()
assert not any(q.startswith("op") and q[2].isdigit() for q in e.queries()), "hidden part registered"
"""


@pytest.mark.parametrize("name", ["public_tokenizers", "applens.llm", "applens.llm.registry"])
def test_entry_without(name):
    code = HIDE.format(name=name, root=ROOT)
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
