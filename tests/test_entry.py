"""The registered queries without the packages that only the training-data operators need."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("hidden", ["public_tokenizers", "zstandard", "corpus_pipeline"])
def test_core_queries_do_not_need_optional_packages(hidden):
    code = (
        f"import sys; sys.modules[{hidden!r}] = None\n"
        "import __spark_entry__ as e\n"
        "from opslens.workload.queries import all_queries\n"
        "assert set(all_queries()) == set(e.queries()) == set(e.oracle_sql())\n"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-500:]
