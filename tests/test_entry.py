"""The entry points without what only the corpus operators need."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(blocked: str | None) -> list[str]:
    block = f"sys.modules[{blocked!r}] = None; " if blocked else ""
    code = f"import sys; {block}import __spark_entry__ as e; e.oracle_sql(); print('\\n'.join(e.queries()))"
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()


def test_other_queries_survive_a_missing_package():
    every = names(None)
    rest = [n for n in every if not n.startswith("op") and n != "pipeline"]
    assert len(rest) > 100
    for package in ("public_tokenizers", "tablegauge.llm"):
        assert names(package) == rest
