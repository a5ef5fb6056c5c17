"""The package runs from any folder: Python workers need no copy of it."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]

CODE = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from brightloom.session import get_session
spark = get_session(master="local[2]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false")
for name in ("c15_python_predicate", "x01_typed_scalar_function", "x04_apply_python_function", "l13_stochastic_gradient_descent", "w01_nearest_per_row"):
    assert entry.queries()[name](spark, {sf_dir!r}).count() > 0, name
print("all ran")
"""


def test_queries_with_python_workers_run_elsewhere(sf_dir, tmp_path):
    done = subprocess.run(
        [sys.executable, "-c", CODE.format(repo=str(REPO), sf_dir=sf_dir)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "all ran" in done.stdout, done.stderr[-3000:]
