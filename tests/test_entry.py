"""The entry without the optional package or with a library of it missing."""
import re
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)


@pytest.mark.parametrize("missing", ["ahocorasick", "ledgerline.llm", "corpus_pipeline", "public_tokenizers"])
def test_core_queries_stay(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; print(len(e.queries()), any(q.startswith('op') for q in e.queries()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    count, llm = out.stdout.split()[-2:]
    assert int(count) > 130 and llm == "False"


def test_nothing_else_imports_the_optional_package():
    for path in Path(ROOT, "ledgerline").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"import .*\bllm\b|from .*\bllm\b", path.read_text()), path
