"""The entry works without the optional operators or a library of theirs."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
CODE = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as e
assert "merge_full_update" in e.queries() and "zone_scan" in e.oracle_sql()
assert not any(q.startswith("op") or q == "pipeline" for q in [*e.queries(), *e.oracle_sql()])
"""


@pytest.mark.parametrize("missing", ["zstandard", "xxhash", "public_tokenizers", "corpus_pipeline", "deidlake.llm"])
def test_entry_without(missing):
    done = subprocess.run([sys.executable, "-c", CODE.format(missing=missing)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
