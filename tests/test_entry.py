"""The entry points stand without the optional packages of the corpus operators."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = """
import sys
class Blocked:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == {name!r} or name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Blocked())
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from tidemark.plans import registry
names = set(entry.queries())
assert set(registry.QUERIES) <= names and len(registry.QUERIES) > 90
assert not any(n.startswith("op") and n[2].isdigit() for n in names) and "pipeline" not in names
assert set(entry.oracle_sql()) <= names
"""


@pytest.mark.parametrize("name", ["public_tokenizers", "pyarrow", "tidemark.llm", "corpus_pipeline"])
def test_import_without(name):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(name=name, root=str(ROOT))],
                          capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
