"""The driver's entry works with and without the training-data operators and what they need."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.parametrize("missing", ["xxhash", "readloom.llm", "corpus_pipeline"])
def test_other_queries_register_without(missing):
    program = (
        "import sys, warnings\n"
        f"sys.modules[{missing!r}] = None\n"
        "with warnings.catch_warnings(record=True) as caught:\n"
        "    warnings.simplefilter('always')\n"
        "    import __spark_entry__ as entry\n"
        "assert any('left out' in str(w.message) for w in caught)\n"
        "names = entry.queries()\n"
        "assert len(names) > 140 and not any(n.startswith('op') and n[2:3].isdigit() for n in names)\n"
        "assert set(entry.oracle_sql()) <= set(names)\n")
    done = subprocess.run([sys.executable, "-c", program], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
