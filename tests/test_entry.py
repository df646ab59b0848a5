"""The driver contract with and without the optional parts."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent

HIDING = """
import importlib.abc, sys
class Hidden(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in {hidden!r} or any(name.startswith(h + ".") for h in {hidden!r}):
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Hidden())
import __spark_entry__ as contract
print(*sorted(contract.queries()))
print(*sorted(contract.oracle_sql()))
"""


def names(*hidden: str) -> tuple[set[str], set[str]]:
    out = subprocess.run([sys.executable, "-c", HIDING.format(hidden=hidden)], cwd=ROOT, check=True, capture_output=True, text=True)
    found, sql = out.stdout.strip().splitlines()[-2:]
    return set(found.split()), set(sql.split())


@pytest.mark.parametrize("hidden", [("basketry.llm",), ("basketry.llm", "corpus_pipeline"), ("public_tokenizers",)])
def test_other_queries_remain(hidden):
    from basketry.registry.oracle import oracle_sql
    from basketry.registry.queries import QUERIES

    found, sql = names(*hidden)
    assert len(found) >= 88 and found == set(QUERIES) and sql == set(oracle_sql())


def test_other_missing_modules_are_not_hidden():
    with pytest.raises(subprocess.CalledProcessError):
        names("basketry.session")
