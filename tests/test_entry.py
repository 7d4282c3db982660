"""The entry points work whether or not the optional subpackage is there."""

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

WITHOUT = """
import sys

class Absent:
    def find_spec(self, name, path=None, target=None):
        if name == "rollbook.llm" or name == "corpus_pipeline":
            raise ModuleNotFoundError(name, name=name)

sys.meta_path.insert(0, Absent())
sys.path.insert(0, {repo!r})
import __spark_entry__ as e
assert "job_finance_long" in e.queries() and set(e.queries()) == set(e.oracle_sql())
assert not [q for q in e.queries() if q.startswith("op")]
"""


def test_without_the_subpackage():
    done = subprocess.run([sys.executable, "-c", WITHOUT.format(repo=str(REPO))], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_it():
    for path in (REPO / "rollbook").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
